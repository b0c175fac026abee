"""TX1-TX7: telemetry lines, command and response lines, user lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import tag_message

# Fixed values that must equal the reference's protocol.
VERBS = ["LOGIN", "MOVE", "LIST_USERS", "GET_DATA", "PING", "LOGOUT"]
RESPONSE_KINDS = ["LOGIN_SUCCESS", "LOGIN_FAIL", "DATA", "MOVE_SUCCESS", "MOVE_FAIL",
                  "USER_LIST", "PONG", "ERROR"]
ERR_INVALID = "ERROR Invalid command"
ERR_PERMISSION = "ERROR No tienes permisos"
ERR_RATE = "ERROR Rate limit"
ERR_UNKNOWN_VAR = "ERROR Unknown var"
SERVER_VARS = ["TEMP", "HUM"]
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799      # of the years 0001 to 9999


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_KV = r"(?:^|;)([^;=]*)=([^;]*)"


def kv_map(payload) -> Column:
    """`k=v;k=v` -> MAP<STRING,DOUBLE>. Entries without '=' or with a broken
    number are skipped; a repeated key keeps its last valid value.

    Fast path (no key repeats, the usual case): keys and values come from one
    regex, values are cast element-wise and zipped into the map. Only lines
    with a repeated key take the exact element-by-element path."""
    keys = F.regexp_extract_all(_c(payload), F.lit(_KV), 1)
    vals = F.regexp_extract_all(_c(payload), F.lit(_KV), 2).try_cast("array<double>")
    fast = F.map_filter(F.map_from_arrays(keys, vals), lambda k, v: v.isNotNull())
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), fast).otherwise(_kv_map_exact(payload))


def _kv_map_exact(payload) -> Column:
    parts = F.filter(F.split(_c(payload), ";"), lambda x: F.instr(x, "=") > 0)
    entries = F.transform(parts, lambda x: F.struct(
        F.substring_index(x, "=", 1).alias("key"),
        F.substring(x, F.instr(x, "=") + 1, F.length(x)).try_cast("double").alias("value")))
    good = F.filter(entries, lambda e: e["value"].isNotNull())
    last_only = F.filter(good, lambda e, i: ~F.exists(F.slice(good, i + 2, F.size(good) + 1),
                                                       lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last_only)


def parse_telemetry(df: DataFrame, line: str = "value") -> DataFrame:
    """TX1 / SS1: `[prefix] DATA <epoch> k=v;k=v` -> epoch, ts, vars.

    Lines tagged other than DATA are dropped (ERROR/MOVE take precedence). A
    display reads only the readings, so every DATA line stays: `epoch` is null
    where it is not a whole number, and `ts`, its time as TIMESTAMP_NTZ, also
    where no timestamp shows it.

    The tag, epoch, payload and map are computed once per line behind
    one-row generators: filters on them cannot be pushed below, so the
    optimizer does not re-evaluate the parse (or the line's own expression)
    per use."""
    rest = F.regexp_extract(_c(line), r"DATA(.*)$", 1)
    toks = F.filter(F.split(F.trim(rest), r"\s+"), lambda t: t != "")
    epoch = F.try_element_at(toks, F.lit(1)).try_cast("long")
    payload = F.coalesce(F.try_element_at(toks, F.lit(2)), F.lit(""))
    head = F.struct(tag_message(line).alias("__tag"), epoch.alias("epoch"), payload.alias("__payload"))
    out = (df.select("*", F.inline(F.array(head)))
           .where(F.col("__tag") == "DATA")
           .drop("__tag"))
    out = (out.select("*", F.inline(F.array(F.struct(kv_map(F.col("__payload")).alias("vars")))))
           .drop("__payload")
           .withColumn("ts", epoch_to_ntz("epoch")))
    return out


def epoch_to_ntz(epoch) -> Column:
    """Whole epoch seconds -> TIMESTAMP_NTZ (UTC wall clock, no session-zone dependence)."""
    e = _c(epoch)
    shown = F.when(e.between(FIRST_SECOND, LAST_SECOND), e)
    return F.timestamp_add("SECOND", shown, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def explode_vars(df: DataFrame, vars_col: str = "vars") -> DataFrame:
    """TX2: one row per (reading, variable)."""
    keep = [c for c in df.columns if c != vars_col]
    return df.select(*keep, F.explode(vars_col).alias("var", "value"))


def one_decimal(x) -> Column:
    return F.format_string("%.1f", _c(x))


def format_data(epoch, temp, hum, var=None) -> Column:
    """TX3: the GET_DATA reply for a variable request: none/ALL -> both,
    TEMP, HUM, anything else -> `ERROR Unknown var`."""
    e = _c(epoch).cast("long").cast("string")
    both = F.concat(F.lit("DATA "), e, F.lit(" TEMP="), one_decimal(temp), F.lit(";HUM="), one_decimal(hum))
    if var is None:
        return both
    v = _c(var)
    return (F.when(v.isNull() | (v == "ALL"), both)
            .when(v == "TEMP", F.concat(F.lit("DATA "), e, F.lit(" TEMP="), one_decimal(temp)))
            .when(v == "HUM", F.concat(F.lit("DATA "), e, F.lit(" HUM="), one_decimal(hum)))
            .otherwise(F.lit(ERR_UNKNOWN_VAR)))


def select_var(df: DataFrame, var, vars_col: str = "vars") -> DataFrame:
    """TX3 on parsed telemetry: keep the requested variable(s) or an error row."""
    v = F.lit(var) if isinstance(var, str) or var is None else var
    m = F.col(vars_col)
    picked = (F.when(v.isNull() | (v == "ALL"), m)
              .when(v.isin(*SERVER_VARS), F.map_filter(m, lambda k, _: k == v)))
    return df.withColumn("selected", picked).withColumn(
        "error", F.when(F.col("selected").isNull(), F.lit(ERR_UNKNOWN_VAR)))


def tokenize_command(line) -> Column:
    """Split on runs of space/newline (strtok(" \\n")): array of tokens."""
    return F.filter(F.split(_c(line), r"[ \n]+"), lambda t: t != "")


def parse_commands(df: DataFrame, line: str = "line") -> DataFrame:
    """TX5: verb, arg1, arg2 and the parse error for unknown/empty verbs."""
    toks = tokenize_command(F.coalesce(_c(line), F.lit("")))
    out = (df.withColumn("_tok", toks)
           .withColumn("verb", F.try_element_at("_tok", F.lit(1)))
           .withColumn("arg1", F.try_element_at("_tok", F.lit(2)))
           .withColumn("arg2", F.try_element_at("_tok", F.lit(3)))
           .drop("_tok"))
    return out.withColumn("parse_error", F.when(
        F.col("verb").isNull() | ~F.col("verb").isin(*VERBS), F.lit(ERR_INVALID)))


def parse_responses(df: DataFrame, line: str = "line") -> DataFrame:
    """TX6: kind (first token), arg (role/direction/timestamp) and reason
    (`OBSTACLE`, or the message of an ERROR)."""
    toks = F.filter(F.split(F.trim(_c(line)), r"\s+"), lambda t: t != "")
    kind = F.try_element_at(toks, F.lit(1))
    a1 = F.try_element_at(toks, F.lit(2))
    a2 = F.try_element_at(toks, F.lit(3))
    msg = F.trim(F.regexp_extract(_c(line), r"^\s*ERROR\s*(.*)$", 1))
    return (df.withColumn("kind", kind)
            .withColumn("arg", F.when(kind.isin("LOGIN_SUCCESS", "MOVE_SUCCESS", "MOVE_FAIL", "DATA", "USER_LIST"), a1))
            .withColumn("reason", F.when(kind == "MOVE_FAIL", a2)
                        .when(kind == "ERROR", F.when(msg != "", msg))))


def user_entry(ip, port) -> Column:
    return F.concat(_c(ip), F.lit(":"), _c(port).cast("string"), F.lit(";"))


def user_list(df: DataFrame, by, ip: str = "ip", port: str = "port") -> DataFrame:
    """TX7: `ip:port;ip:port;` per group (sorted for determinism). The group is
    the set of clients connected at one instant, and the text is as long as it: a
    server that admits few clients has short ones, a table may have long ones."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(
        F.array_join(F.sort_array(F.collect_list(user_entry(ip, port))), "").alias("users"),
        F.count(F.lit(1)).alias("n_users"))
