"""Streaming queries (SS1-SS7, IO3, IO4, IO8): file streams over the driver's
events run to completion with availableNow; the oracle is the batch SQL of the
same result, restricted to windows the watermark has closed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from ..streaming import ops as SO
from .commands_q import _ADMIN_SQL, _PARSE_CMD_SQL
from .derived import PARSED_SQL, commands_from, telemetry_lines, telemetry_lines_from
from .registry import query, rnd


def _parsed_stream(spark, sf):
    return SO.parse_stream(telemetry_lines_from(SO.events_stream(spark, sf)), "line")


@query("stream_parse", oracle=f"""
WITH {PARSED_SQL}
SELECT event_id, epoch, temp, hum, CAST(n_vars AS INTEGER) AS n_vars FROM parsed""")
def q_stream_parse(spark, sf):
    p = _parsed_stream(spark, sf).select("event_id", "epoch", "temp", "hum", F.size(F.map_keys("vars")).alias("n_vars"))
    return SO.run_append(p, spark, "parse")


@query("stream_tick_windows", oracle=f"""
WITH {PARSED_SQL},
w AS (SELECT (epoch // 15) * 15 AS window_start, count(*) AS readings, round(avg(temp), 6) AS avg_temp, max(hum) AS max_hum
      FROM parsed GROUP BY 1)
SELECT * FROM w WHERE window_start + 15 <= (SELECT max(epoch) FROM parsed) - 60""")
def q_stream_tick_windows(spark, sf):
    w = SO.tick_windows(_parsed_stream(spark, sf), "15 seconds", "1 minute")
    out = SO.run_append(w, spark, "ticks")
    return out.select(F.unix_timestamp("w.start").alias("window_start"), "readings",
                      rnd("avg_temp").alias("avg_temp"), "max_hum")


@query("stream_latest", oracle=f"""
WITH {PARSED_SQL}
SELECT sensor_id, epoch, temp, hum FROM parsed WHERE temp IS NOT NULL AND hum IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY epoch DESC, event_id DESC) = 1""")
def q_stream_latest(spark, sf):
    p = _parsed_stream(spark, sf).where(F.col("temp").isNotNull() & F.col("hum").isNotNull())
    out = SO.run_update(SO.latest_stream(p, "sensor_id"), spark, "latest", ["sensor_id"])
    return out.select("sensor_id", "l.epoch", "l.temp", "l.hum")


@query("stream_rate_limit", oracle="""
WITH e AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
f AS (SELECT user_id, event_type, (s // 3600) * 3600 AS tick_start, event_id,
             row_number() OVER (PARTITION BY user_id, event_type, s // 3600 ORDER BY s, event_id) AS rn FROM e)
SELECT user_id, event_type, tick_start, event_id AS accepted_id FROM f
WHERE rn = 1 AND tick_start + 3600 <= (SELECT max(s) FROM e) - 3600""")
def q_stream_rate_limit(spark, sf):
    r = SO.rate_limit_stream(SO.events_stream(spark, sf), ["user_id", "event_type"], "1 hour", "1 hour")
    out = SO.run_append(r, spark, "ratelimit")
    return out.select("user_id", "event_type", F.unix_timestamp("tick.start").alias("tick_start"),
                      F.col("first.event_id").alias("accepted_id"))


@query("stream_match", oracle="""
WITH e AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
SELECT r.event_id AS request_id, t.event_id AS tick_id
FROM e r JOIN e t ON r.user_id = t.user_id AND t.s <= r.s AND t.s >= r.s - 3600
WHERE r.event_type = 'purchase' AND t.event_type = 'view'""")
def q_stream_match(spark, sf):
    e = SO.events_stream(spark, sf).withColumn("ets", SO.event_time("ts"))
    req = e.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("request_id"),
                                                            F.col("user_id").alias("r_key"), F.col("ets").alias("r_ets"))
    tick = e.where(F.col("event_type") == "view").select(F.col("event_id").alias("tick_id"),
                                                         F.col("user_id").alias("t_key"), F.col("ets").alias("t_ets"))
    j = SO.match_requests(req, tick, "r_key", "1 hour", "2 hours").select("request_id", "tick_id")
    return SO.run_append(j, spark, "match")


@query("stream_sessions", oracle="""
WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
g AS (SELECT user_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) <= 1800 THEN 0 ELSE 1 END AS new FROM e),
k AS (SELECT user_id, s, sum(new) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS sid FROM g),
ss AS (SELECT user_id, min(s) AS session_start, max(s) + 1800 AS session_end, count(*) AS events FROM k GROUP BY user_id, sid)
SELECT * FROM ss WHERE session_end <= (SELECT max(s) FROM e) - 600""")
def q_stream_sessions(spark, sf):
    s = SO.session_windows(SO.events_stream(spark, sf), "user_id", "30 minutes", "10 minutes")
    out = SO.run_append(s, spark, "sessions")
    return out.select("user_id", F.unix_timestamp("s.start").alias("session_start"),
                      F.unix_timestamp("s.end").alias("session_end"), "events")


@query("stream_session_state", oracle=f"""
WITH {_PARSE_CMD_SQL}, {_ADMIN_SQL}
SELECT cmd_id, session_id, CAST(is_admin AS INTEGER) AS is_admin,
       row_number() OVER (PARTITION BY session_id ORDER BY ts, cmd_id) AS n_commands FROM ad""")
def q_stream_session_state(spark, sf):
    c = commands_from(SO.events_stream(spark, sf))
    return SO.run_append(SO.session_state_stream(c), spark, "state")


def _write_log(spark, sf):
    """Telemetry lines written as a text log (several files) in the shared folder."""
    path = scratch_path(spark, f"telemetry-log-{uuid.uuid4().hex}")
    telemetry_lines(spark, sf).select("line").repartition(4).write.mode("overwrite").text(path)
    return path


_LOG_SQL = f"""
WITH {PARSED_SQL}
SELECT epoch, temp, hum, CAST(n_vars AS INTEGER) AS n_vars FROM parsed"""


@query("read_telemetry_log", oracle=_LOG_SQL)
def q_read_telemetry_log(spark, sf):
    """IO3: batch read of a telemetry text log."""
    p = R.read_telemetry(spark, _write_log(spark, sf))
    return p.select("epoch", F.col("vars").getItem("TEMP").alias("temp"), F.col("vars").getItem("HUM").alias("hum"),
                    F.size(F.map_keys("vars")).alias("n_vars"))


@query("stream_telemetry_files", oracle=_LOG_SQL)
def q_stream_telemetry_files(spark, sf):
    """IO4: the live feed as a directory of log files (text file stream)."""
    s = R.stream_telemetry(spark, _write_log(spark, sf), max_files_per_trigger=1)
    p = s.select("epoch", F.col("vars").getItem("TEMP").alias("temp"), F.col("vars").getItem("HUM").alias("hum"),
                 F.size(F.map_keys("vars")).alias("n_vars"))
    return SO.run_append(p, spark, "logfeed")


@query("stream_log_sink", oracle=f"""
WITH {PARSED_SQL}
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n FROM parsed GROUP BY 1""")
def q_stream_log_sink(spark, sf):
    """IO8: append-only parquet log, size-bounded files, one folder per date."""
    p = _parsed_stream(spark, sf).select("event_id", "ts", "epoch", "temp", "hum")
    base = scratch_path(spark, f"log-sink-{uuid.uuid4().hex}")
    q = K.write_log_stream(p, f"{base}/out", f"{base}/ck", max_records_per_file=1000)
    q.awaitTermination()
    t = spark.read.parquet(f"{base}/out")
    return t.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))
