"""Recorded-form tables derived from the driver's `events` (work grows with it).

Each builder has a SQL twin so the oracle recomputes the same input.
Numbers are rendered from integer arithmetic (floor of value*10) so the text
is identical in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import table

# --- telemetry lines: one per event, in five shapes ---

def _t10():
    return (F.floor(F.col("value") * 10) % 500).cast("long")


def _dec(t10):
    return F.concat((t10 / 10).cast("long").cast("string"), F.lit("."), (t10 % 10).cast("string"))


def telemetry_lines(spark, sf):
    return telemetry_lines_from(table(spark, sf, "events"))


def telemetry_lines_from(e):
    """Works on a batch table or a stream of events."""
    epoch = F.unix_timestamp("ts").cast("string")
    k = F.get_json_object("props", "$.k").cast("long")
    temp = _dec(_t10())
    hum = F.concat(k.cast("string"), F.lit("."), (F.col("event_id") % 10).cast("string"))
    et = F.col("event_type")
    line = (F.when(et == "view", F.concat(F.lit("[Servidor] DATA "), epoch, F.lit(" TEMP="), temp, F.lit(";HUM="), hum))
            .when(et == "click", F.concat(F.lit("DATA "), epoch, F.lit(" TEMP="), temp, F.lit(";HUM="), hum,
                                          F.lit(";PRES="), (k + 1000).cast("string"), F.lit(".5;WIND="),
                                          (F.col("event_id") % 40).cast("string"), F.lit(".0")))
            .when(et == "purchase", F.concat(F.lit("DATA "), epoch, F.lit(" TEMP="), _dec(_t10() + 400),
                                             F.lit(";HUM="), (k + 50).cast("string"), F.lit(".0")))
            .when(et == "error", F.concat(F.lit("DATA "), epoch, F.lit(" TEMP=x"), temp, F.lit(";HUM="), hum))
            .otherwise(F.when(F.col("event_id") % 2 == 0, F.lit("ERROR DATA corrupted"))
                       .otherwise(F.concat(F.lit("DATA "), epoch))))
    return e.select("event_id", "ts", (F.col("user_id") % 10).alias("sensor_id"), line.alias("line"))


_EP = "CAST(floor(epoch(ts)) AS BIGINT)"
_T10 = "(CAST(floor(value * 10) AS BIGINT) % 500)"
_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def _dec_sql(t10):
    return f"CAST(({t10}) // 10 AS VARCHAR) || '.' || CAST(({t10}) % 10 AS VARCHAR)"


_TEMP = _dec_sql(_T10)
_HUM = f"CAST({_K} AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR)"
TELEMETRY_LINES_SQL = f"""
SELECT event_id, ts, user_id % 10 AS sensor_id,
  CASE event_type
    WHEN 'view' THEN '[Servidor] DATA ' || CAST({_EP} AS VARCHAR) || ' TEMP=' || {_TEMP} || ';HUM=' || {_HUM}
    WHEN 'click' THEN 'DATA ' || CAST({_EP} AS VARCHAR) || ' TEMP=' || {_TEMP} || ';HUM=' || {_HUM}
         || ';PRES=' || CAST({_K} + 1000 AS VARCHAR) || '.5;WIND=' || CAST(event_id % 40 AS VARCHAR) || '.0'
    WHEN 'purchase' THEN 'DATA ' || CAST({_EP} AS VARCHAR) || ' TEMP=' || {_dec_sql(_T10 + " + 400")}
         || ';HUM=' || CAST({_K} + 50 AS VARCHAR) || '.0'
    WHEN 'error' THEN 'DATA ' || CAST({_EP} AS VARCHAR) || ' TEMP=x' || {_TEMP} || ';HUM=' || {_HUM}
    ELSE CASE WHEN event_id % 2 = 0 THEN 'ERROR DATA corrupted' ELSE 'DATA ' || CAST({_EP} AS VARCHAR) END
  END AS line
FROM events"""

# SQL twin of parse_telemetry + with_readings (TX1, PR8); a repeated key keeps its last value.
PARSED_SQL = f"""
lines AS ({TELEMETRY_LINES_SQL}),
tagged AS (SELECT * FROM lines WHERE NOT contains(line, 'ERROR') AND NOT (contains(line, 'MOVE_') OR contains(line, 'MOVE '))
           AND contains(line, 'DATA ')),
toks AS (SELECT event_id, ts, sensor_id, list_filter(string_split_regex(trim(regexp_extract(line, 'DATA(.*)$', 1)), '\\s+'), lambda x: x <> '') AS tok FROM tagged),
pe AS (SELECT event_id, sensor_id, TRY_CAST(tok[1] AS BIGINT) AS epoch,
              list_filter(string_split(coalesce(tok[2], ''), ';'), lambda x: strpos(x, '=') > 0) AS kvs FROM toks),
good AS (SELECT event_id, sensor_id, epoch,
           list_filter(kvs, lambda x: TRY_CAST(substr(x, strpos(x, '=') + 1) AS DOUBLE) IS NOT NULL) AS kv FROM pe),
parsed AS (SELECT event_id, sensor_id, CASE WHEN epoch BETWEEN -62135596800 AND 253402300799 THEN make_timestamp(epoch * 1000000) END AS ts, epoch,
   TRY_CAST(substr(list_filter(kv, lambda x: split_part(x, '=', 1) = 'TEMP')[-1], strpos(list_filter(kv, lambda x: split_part(x, '=', 1) = 'TEMP')[-1], '=') + 1) AS DOUBLE) AS temp,
   TRY_CAST(substr(list_filter(kv, lambda x: split_part(x, '=', 1) = 'HUM')[-1], strpos(list_filter(kv, lambda x: split_part(x, '=', 1) = 'HUM')[-1], '=') + 1) AS DOUBLE) AS hum,
   len(list_distinct(list_transform(kv, lambda x: split_part(x, '=', 1)))) AS n_vars FROM good)"""


# --- command log: one command per event, sessions per user and day ---

DIRS = ["UP", "DOWN", "LEFT", "RIGHT"]
GET_VARS = ["TEMP", "HUM", "ALL", "PRES"]


def _pick(arr, idx):
    return F.element_at(F.array(*[F.lit(x) for x in arr]), (idx + 1).cast("int"))


def commands(spark, sf):
    return commands_from(table(spark, sf, "events"))


def commands_with_outcome(spark, sf):
    """The command log with a recorded outcome: an event of value 80 and more met an obstacle."""
    e = table(spark, sf, "events")
    return commands_from(e, (F.col("value") >= 80).alias("obstacle"))


def commands_from(e, *more):
    """Works on a batch table or a stream of events; `more` columns are carried along."""
    e = e.select("event_id", "ts", "user_id", "event_type", *more)
    i = F.col("event_id")
    et = F.col("event_type")
    line = (F.when(et == "signup", F.when(i % 3 == 0, F.lit("LOGIN ADMIN admin"))
                   .when(i % 3 == 1, F.lit("LOGIN USER -")).otherwise(F.lit("LOGIN ADMIN wrong")))
            .when(et == "purchase", F.when(i % 7 == 0, F.lit("MOVE"))
                  .otherwise(F.concat(F.lit("MOVE "), _pick(DIRS, i % 4))))
            .when(et == "view", F.when(i % 9 == 0, F.lit("GET_DATA"))
                  .otherwise(F.concat(F.lit("GET_DATA "), _pick(GET_VARS, i % 4))))
            .when(et == "click", F.lit("PING"))
            .otherwise(F.when(i % 3 == 0, F.lit("LIST_USERS")).when(i % 3 == 1, F.lit("JUMP high"))
                       .otherwise(F.lit(""))))
    sid = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
    return e.select(i.alias("cmd_id"), sid.alias("session_id"), "user_id", "ts", line.alias("line"), *e.columns[4:])


COMMANDS_SQL = """
SELECT event_id AS cmd_id, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id, user_id, ts,
  CASE event_type
    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'LOGIN ADMIN admin' WHEN 1 THEN 'LOGIN USER -' ELSE 'LOGIN ADMIN wrong' END
    WHEN 'purchase' THEN CASE WHEN event_id % 7 = 0 THEN 'MOVE' ELSE 'MOVE ' || ['UP', 'DOWN', 'LEFT', 'RIGHT'][event_id % 4 + 1] END
    WHEN 'view' THEN CASE WHEN event_id % 9 = 0 THEN 'GET_DATA' ELSE 'GET_DATA ' || ['TEMP', 'HUM', 'ALL', 'PRES'][event_id % 4 + 1] END
    WHEN 'click' THEN 'PING'
    ELSE CASE event_id % 3 WHEN 0 THEN 'LIST_USERS' WHEN 1 THEN 'JUMP high' ELSE '' END
  END AS line
FROM events"""


def sessions(spark, sf):
    c = commands(spark, sf)
    uid = F.col("user_id")
    ip = F.concat(F.lit("10.0."), (uid / 256).cast("long").cast("string"), F.lit("."), (uid % 256).cast("string"))
    return (c.groupBy("session_id", "user_id")
            .agg(F.min("ts").alias("connect_ts"), F.max("ts").alias("disconnect_ts"))
            .select("session_id", ip.alias("ip"), (F.lit(40000) + uid).cast("int").alias("port"),
                    "connect_ts", "disconnect_ts"))


SESSIONS_SQL = f"""
SELECT session_id, '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip, CAST(40000 + user_id AS INTEGER) AS port,
       min(ts) AS connect_ts, max(ts) AS disconnect_ts
FROM ({COMMANDS_SQL}) GROUP BY session_id, user_id"""


def hourly_ticks(spark, sf):
    """One tick per hour between the first and last event (derived range)."""
    e = table(spark, sf, "events")
    from ..functions.text import epoch_to_ntz
    # epoch arithmetic keeps the grid TIMESTAMP_NTZ (date_trunc would return a zoned TIMESTAMP)
    r = e.agg((F.floor(F.min(F.unix_timestamp("ts")) / 3600) * 3600).cast("long").alias("lo"),
              F.max(F.unix_timestamp("ts")).alias("hi"))
    t = r.select(F.explode(F.sequence("lo", "hi", F.lit(3600).cast("long"))).alias("tick_epoch"))
    return t.select(epoch_to_ntz("tick_epoch").alias("tick_ts"))


TICKS_SQL = """
SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS tick_ts FROM events"""


# --- flow history for the link measures ---

def _client():
    m = F.col("user_id") % 10
    name = (F.when(m < 3, F.lit("Reno")).when(m < 6, F.lit("Cubic")).when(m < 9, F.lit("BBR"))
            .otherwise(F.lit("Custom")))
    return F.concat(name, F.lit("_"), m.cast("string"))


def packets(spark, sf):
    e = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    scen = F.when(F.dayofmonth("ts") <= 15, F.lit("first_half")).otherwise(F.lit("second_half"))
    return e.select(scen.alias("scenario"), F.floor(F.unix_timestamp("ts") / 3600).cast("long").alias("t"),
                    _client().alias("client"), (F.col("event_type") != "error").alias("served"),
                    F.col("value").alias("rtt_ms"))


PACKETS_SQL = """
SELECT CASE WHEN day(ts) <= 15 THEN 'first_half' ELSE 'second_half' END AS scenario,
       CAST(floor(epoch(ts) / 3600) AS BIGINT) AS t,
       CASE WHEN user_id % 10 < 3 THEN 'Reno' WHEN user_id % 10 < 6 THEN 'Cubic' WHEN user_id % 10 < 9 THEN 'BBR' ELSE 'Custom' END
         || '_' || CAST(user_id % 10 AS VARCHAR) AS client,
       event_type <> 'error' AS served, value AS rtt_ms
FROM events"""


def history(spark, sf):
    p = packets(spark, sf)
    return p.groupBy("scenario", "t", "client").agg(
        F.count_if("served").alias("throughput"), F.count_if(~F.col("served")).alias("drops"),
        F.avg("rtt_ms").alias("rtt_ms"))


HISTORY_SQL = f"""
SELECT scenario, t, client, count_if(served) AS throughput, count_if(NOT served) AS drops, avg(rtt_ms) AS rtt_ms
FROM ({PACKETS_SQL}) GROUP BY scenario, t, client"""

DENSE_SQL = f"""
h AS ({HISTORY_SQL}),
rng AS (SELECT scenario, min(t) AS lo, max(t) AS hi FROM h GROUP BY scenario),
ks AS (SELECT DISTINCT scenario, client FROM h),
grid AS (SELECT ks.scenario, ks.client, unnest(generate_series(rng.lo, rng.hi)) AS t FROM ks JOIN rng ON ks.scenario = rng.scenario),
dense AS (SELECT g.scenario, g.t, g.client, coalesce(h.throughput, 0) AS throughput, coalesce(h.drops, 0) AS drops, h.rtt_ms
          FROM grid g LEFT JOIN h ON g.scenario = h.scenario AND g.t = h.t AND g.client = h.client)"""


# --- a content key for lineitem rows: (orderkey, linenumber) repeats in the
# driver data, the full row does not. Integer renderings keep it identical in
# both engines.

def line_key():
    cents = lambda c: F.round(F.col(c) * 100).cast("long").cast("string")
    parts = [F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
             F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), cents("l_extendedprice"),
             cents("l_quantity"), cents("l_discount"), cents("l_tax"), F.unix_timestamp("l_shipdate").cast("string")]
    return F.concat_ws("-", *parts)


def line_key_sql(p=""):
    c = lambda x: f"CAST(round({p}{x} * 100) AS BIGINT)"
    return (f"concat_ws('-', {p}l_orderkey, {p}l_linenumber, {p}l_partkey, {p}l_suppkey, {c('l_extendedprice')}, "
            f"{c('l_quantity')}, {c('l_discount')}, {c('l_tax')}, CAST(floor(epoch({p}l_shipdate)) AS BIGINT))")


# --- connection records (NSL-KDD form) derived from lineitem x orders ---
# Learnable label: attacks are high-discount bulk lines and zero-tax lines.

def connection_records(spark, sf):
    from ..functions.hashing import uniform
    from ..sources.readers import CONNECTION_COLUMNS
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                             "l_shipdate")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice", "o_orderpriority")
    j = li.join(o, "l_orderkey")
    j = j.withColumn("conn_id", line_key())
    split = F.when(uniform("conn_id", 42, "split") < 0.2, F.lit("test")).otherwise(F.lit("train"))
    j = j.withColumn("split", split)
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    service = F.when((F.col("split") == "test") & (ln == 7), F.lit("x11")).otherwise(
        F.regexp_replace(F.lower(F.substring("o_orderpriority", 3, 100)), " ", "_"))
    flag = (F.when((F.col("split") == "train") & (ln == 6) & (F.year("l_shipdate") == 1995), F.lit("REJ"))
            .when(ls == "F", F.lit("SF")).otherwise(F.lit("S0")))
    attack = (F.when((F.col("l_discount") > 0.05) & (F.col("l_quantity") > 25), F.lit("neptune"))
              .when(F.col("l_tax") < 0.01, F.lit("smurf"))
              .when(ln == 5, F.lit(None).cast("string")).otherwise(F.lit("normal")))
    vals = {
        "duration": (F.col("l_quantity") - 1).cast("long"),
        "protocol_type": F.when(rf == "A", "tcp").when(rf == "N", "udp").otherwise("icmp"),
        "service": service, "flag": flag,
        "src_bytes": F.floor(F.col("l_extendedprice")).cast("long"),
        "dst_bytes": F.when(rf == "R", F.lit(0)).otherwise(F.floor(F.col("o_totalprice") / 10)).cast("long"),
        "hot": (ln - 1).cast("long"), "logged_in": (ls == "O").cast("long"),
        "count": F.floor(F.col("l_quantity") * 2).cast("long"),
        "srv_count": F.floor(F.col("l_extendedprice") / 1000).cast("long"),
        "serror_rate": F.col("l_discount") * 10, "rerror_rate": F.col("l_tax") * 12.5,
        "same_srv_rate": F.col("l_quantity") / 50.0,
        "dst_host_count": (F.col("l_orderkey") % 256).cast("long"),
        "attack": attack, "difficulty": ln.cast("int"),
    }
    from ..sources.readers import connection_schema
    types = {f.name: f.dataType for f in connection_schema().fields}
    cols = []
    for c in CONNECTION_COLUMNS:
        e = vals.get(c)
        if e is None:
            e = F.lit(0.0) if c.endswith("_rate") else F.lit(0)
        cols.append(e.cast(types[c]).alias(c))
    return j.select("conn_id", "split", *cols)


CONNECTION_SQL = f"""
WITH j AS (
  SELECT l.*, o.o_totalprice, o.o_orderpriority, {line_key_sql("l.")} AS conn_id FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
s AS (SELECT *, CASE WHEN ('0x' || substr(md5(CAST(conn_id AS VARCHAR) || '42' || 'split'), 1, 8))::BIGINT / 4294967296.0 < 0.2
                     THEN 'test' ELSE 'train' END AS split FROM j)
SELECT conn_id, split,
  CAST(l_quantity - 1 AS BIGINT) AS duration,
  CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' ELSE 'icmp' END AS protocol_type,
  CASE WHEN split = 'test' AND l_linenumber = 7 THEN 'x11' ELSE replace(lower(substr(o_orderpriority, 3, 100)), ' ', '_') END AS service,
  CASE WHEN split = 'train' AND l_linenumber = 6 AND year(l_shipdate) = 1995 THEN 'REJ' WHEN l_linestatus = 'F' THEN 'SF' ELSE 'S0' END AS flag,
  CAST(floor(l_extendedprice) AS BIGINT) AS src_bytes,
  CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE floor(o_totalprice / 10) END AS BIGINT) AS dst_bytes,
  CAST(0 AS BIGINT) AS land, CAST(l_linenumber - 1 AS BIGINT) AS hot,
  CAST(l_linestatus = 'O' AS BIGINT) AS logged_in,
  CAST(floor(l_quantity * 2) AS BIGINT) AS count, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS srv_count,
  l_discount * 10 AS serror_rate, l_tax * 12.5 AS rerror_rate, l_quantity / 50.0 AS same_srv_rate,
  CAST(l_orderkey % 256 AS BIGINT) AS dst_host_count,
  CASE WHEN l_discount > 0.05 AND l_quantity > 25 THEN 'neptune' WHEN l_tax < 0.01 THEN 'smurf'
       WHEN l_linenumber = 5 THEN NULL ELSE 'normal' END AS attack,
  CAST(l_linenumber AS INTEGER) AS difficulty
FROM s"""
