"""Query registry: name -> Spark builder (spark, sf_dir) -> DataFrame, and
name -> independent SQL text for the DuckDB oracle (omitted where the
operator is not SQL-expressible, e.g. model fits and streaming state)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rnd(c, n: int = 6):
    """Round a double for exact comparison with the oracle, defined as
    round(x * 10^n) / 10^n in floating point on both sides (the SQL engine's
    round(x, n)), so values within an ulp of a half agree."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    m = float(10 ** n)
    return F.round(x * F.lit(m), 0) / F.lit(m)


def load_all():
    """Import every plan module so its queries register."""
    from . import (detection, eda, features_q, models_q, telemetry_q, commands_q,  # noqa: F401
                   links_q, streaming_q, io_q)
    return QUERIES, ORACLE
