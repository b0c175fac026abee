"""Local stand-in for the driver's correctness gate: run a registered query in
Spark and its oracle SQL in DuckDB on the same parquet tables, then compare
row count, column names and an order-insensitive multiset of rounded values."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

from netquery.plans.registry import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                  "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def type_mismatches(sdf, rel):
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    duck_types = {d[0]: str(d[1]) for d in rel.description}
    out = {}
    for name, t in sdf.dtypes:
        want = _SPARK_TO_DUCK.get(t, t.upper())
        got = duck_types.get(name)
        if got is not None and got.upper() != want:
            out[name] = (t, got)
    return out


def compare(spark, name, builder, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    sdf = builder(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    tm = type_mismatches(sdf, rel)
    if tm:
        res["type_mismatch"] = tm
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_oracle"] = [x for x in b if x not in sa][:3]
    res["ok"] = res["cols_match"] and res["values_match"] and len(s_rows) == len(d_rows) and not tm
    return res
