"""SS1-SS7: streaming parse, tick windows, latest value, rate limit, request
to tick matching, session windows and keyed session state.

Event time is the server clock (whole seconds) as a TIMESTAMP instant, so
watermarks work and results do not depend on the session time zone."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as TX
from ..functions.scalar import epoch_micros
from ..session import scratch_path


def events_stream(spark: SparkSession, directory: str, name: str = "events", max_files: int | None = None) -> DataFrame:
    """A file stream over the table `<directory>/<name>.parquet`, one file or a
    folder of files (schema taken from the table). A pattern that matches just
    this name serves both: a plain path would have to be a folder."""
    base = f"{directory.rstrip('/')}/{name}"
    r = spark.readStream.schema(spark.read.parquet(f"{base}.parquet").schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{base}.parque[t]")


def event_time(ts) -> F.Column:
    """Whole-second TIMESTAMP instant of a (NTZ or LTZ) timestamp."""
    return F.timestamp_seconds(F.floor(epoch_micros(ts) / 1_000_000))


def parse_stream(lines: DataFrame, line: str = "line") -> DataFrame:
    """SS1: stateless parse of telemetry lines (TX1) plus event time."""
    p = TX.parse_telemetry(lines, line)
    return (p.withColumn("temp", F.col("vars").getItem("TEMP")).withColumn("hum", F.col("vars").getItem("HUM"))
            .withColumn("ets", F.timestamp_seconds("epoch")))


def tick_windows(parsed: DataFrame, width: str = "15 seconds", delay: str = "1 minute") -> DataFrame:
    """SS2: tumbling windows of readings; a window is final once the watermark passes its end."""
    return (parsed.withWatermark("ets", delay).groupBy(F.window("ets", width).alias("w"))
            .agg(F.count(F.lit(1)).alias("readings"), F.avg("temp").alias("avg_temp"), F.max("hum").alias("max_hum")))


def latest_stream(parsed: DataFrame, key: str) -> DataFrame:
    """SS3: newest reading per sensor (update mode); ties by log position."""
    return parsed.groupBy(key).agg(F.max_by(F.struct("epoch", "temp", "hum"), F.struct("epoch", "event_id")).alias("l"))


def rate_limit_stream(events: DataFrame, keys: list[str], resolution: str = "1 hour", delay: str = "1 hour",
                      order: str = "event_id") -> DataFrame:
    """SS4: the accepted request of each (key, clock tick): the first of the
    tick, emitted once the watermark closes the tick (append mode)."""
    e = events.withColumn("ets", event_time("ts"))
    return (e.withWatermark("ets", delay).groupBy(*keys, F.window("ets", resolution).alias("tick"))
            .agg(F.min(F.struct("ets", order)).alias("first")))


def match_requests(requests: DataFrame, ticks: DataFrame, key: str, within: str = "1 hour",
                   delay: str = "2 hours") -> DataFrame:
    """SS5: stream-stream interval join: each request meets the ticks of its
    key in the preceding `within`; both watermarks bound the join state."""
    r = requests.withWatermark("r_ets", delay)
    t = ticks.withWatermark("t_ets", delay)
    cond = ((F.col("r_key") == F.col("t_key")) & (F.col("t_ets") <= F.col("r_ets"))
            & (F.col("t_ets") >= F.col("r_ets") - F.expr(f"INTERVAL {within}")))
    return r.join(t, cond, "inner")


def session_windows(events: DataFrame, key: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """SS6: activity sessions per client (a gap longer than `gap` closes one)."""
    e = events.withColumn("ets", event_time("ts"))
    return (e.withWatermark("ets", delay).groupBy(key, F.session_window("ets", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("events")))


ADMIN_OUT = "cmd_id long, session_id string, is_admin int, n_commands long"
ADMIN_STATE = "sessions array<string>, admin_ts array<long>, admin_id array<long>, n array<long>"
STATE_BUCKETS = 16384        # groups of the session state; a group holds the sessions of one hash bucket


def _admin_state_fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """For the sessions of a bucket: admin flag in force for each command and a running count.
    State = for each session (first admin login (micros, id), commands seen). Vectorised: the
    flag is "strictly after the earliest successful admin login"."""
    import numpy as np
    names, logins, ids, seen = state.get if state.exists else ((), (), (), ())
    pdf = pd.concat(list(batches), ignore_index=True)
    known = len(names)
    code, who = pd.factorize(np.array([*names, *pdf["session_id"]], dtype=object), use_na_sentinel=False)    # the known ones first
    m, at = len(who), code[known:]
    has, t, i, n = np.zeros(m, dtype=bool), *np.zeros((3, m), dtype="int64")
    has[:known] = [v is not None for v in logins]
    t[:known], i[:known], n[:known] = [v or 0 for v in logins], [v or 0 for v in ids], seen
    us, cid = pdf["us"].to_numpy(dtype="int64"), pdf["cmd_id"].to_numpy(dtype="int64")
    order = np.lexsort((cid, us, at))
    at, us, cid, ok = at[order], us[order], cid[order], pdf["admin_login"].to_numpy(dtype=bool)[order]
    hits = np.flatnonzero(ok)
    s, first = np.unique(at[hits], return_index=True)
    nt, ni = us[hits[first]], cid[hits[first]]
    earlier = ~has[s] | (nt < t[s]) | ((nt == t[s]) & (ni < i[s]))
    s = s[earlier]
    has[s], t[s], i[s] = True, nt[earlier], ni[earlier]
    flags = (has[at] & ((us > t[at]) | ((us == t[at]) & (cid > i[at])))).astype("int32")
    counts = n[at] + np.arange(1, len(at) + 1) - np.searchsorted(at, np.arange(m))[at]
    n += np.bincount(at, minlength=m)
    own = [None if pd.isna(v) else v for v in who]
    state.update((own, [v if h else None for h, v in zip(has, t.tolist())], [v if h else None for h, v in zip(has, i.tolist())], n.tolist()))
    yield pd.DataFrame({"cmd_id": cid, "session_id": np.array(own, dtype=object)[at], "is_admin": flags, "n_commands": counts})


def session_state_stream(commands: DataFrame, password: str = "admin", buckets: int = STATE_BUCKETS) -> DataFrame:
    """SS7: keyed state per session with applyInPandasWithState. Commands of a
    session arrive in event-time order within a micro-batch (sorted here);
    the state carries the admin login across batches. Sessions are many and small, and each group
    is a call of its own, so the sessions of a hash bucket share one; more sessions make its arrays longer."""
    p = TX.parse_commands(commands, "line")
    ok = (F.col("verb") == "LOGIN") & (F.col("arg1") == "ADMIN") & F.col("arg2").eqNullSafe(F.lit(password))
    x = p.select("session_id", "cmd_id", F.coalesce(epoch_micros("ts"), F.lit(-1 << 63)).alias("us"), F.coalesce(ok, F.lit(False)).alias("admin_login"),
                 F.pmod(F.xxhash64("session_id"), F.lit(buckets)).alias("bucket"))
    return x.groupBy("bucket").applyInPandasWithState(
        _admin_state_fn, ADMIN_OUT, ADMIN_STATE, "append", GroupStateTimeout.NoTimeout)


# ---------------- runners ----------------

def run_append(df: DataFrame, spark: SparkSession, name: str, partition_by: str | None = None,
               max_records_per_file: int | None = None) -> DataFrame:
    """Run a streaming query to completion (availableNow) into a parquet sink
    under the shared checkpoint folder and return the written table."""
    base = scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex}")
    w = (df.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    q = w.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(f"{base}/out")


def run_update(df: DataFrame, spark: SparkSession, name: str, keys: list[str]) -> DataFrame:
    """Update-mode query: every micro-batch appends its changed rows with the
    batch id (foreachBatch, idempotent per batch id); the current table is the
    newest row per key."""
    base = scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex}")

    def sink(bdf: DataFrame, batch_id: int):
        bdf.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    q = (df.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ck")
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    t = spark.read.parquet(f"{base}/out")
    cols = [c for c in t.columns if c not in keys and c != "batch"]
    return (t.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("r")).select(*keys, "r.*"))
