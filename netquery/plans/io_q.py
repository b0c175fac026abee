"""Source/sink round trips (IO1, IO2, IO5): the derived connection records are
written as CSV under the session's shared checkpoint folder and read back with
the fixed schema; the oracle computes the same aggregate from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalar import attack_label
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from .derived import CONNECTION_SQL, connection_records
from .registry import query, rnd


def _roundtrip_headerless(spark, sf):
    path = scratch_path(spark, f"connections-{uuid.uuid4().hex}")
    recs = connection_records(spark, sf).where(F.col("split") == "train").select(*R.CONNECTION_COLUMNS)
    recs.write.mode("overwrite").option("header", False).csv(path)
    return R.read_connections(spark, path)


@query("read_connections_csv", oracle=f"""
WITH c AS ({CONNECTION_SQL})
SELECT protocol_type, CASE WHEN attack IS NOT DISTINCT FROM 'normal' THEN 0 ELSE 1 END AS label, count(*) AS n,
       CAST(sum(src_bytes) AS BIGINT) AS src_bytes, CAST(sum(dst_bytes) AS BIGINT) AS dst_bytes,
       round(avg(serror_rate), 6) AS serror_rate, CAST(count_if(attack IS NULL) AS BIGINT) AS missing_attack
FROM c WHERE split = 'train' GROUP BY ALL""")
def q_read_connections_csv(spark, sf):
    """IO1 + IO5: headerless CSV with imposed names and types."""
    c = _roundtrip_headerless(spark, sf)
    return c.groupBy("protocol_type", attack_label("attack").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("src_bytes").cast("long").alias("src_bytes"),
        F.sum("dst_bytes").cast("long").alias("dst_bytes"), rnd(F.avg("serror_rate")).alias("serror_rate"),
        F.count_if(F.col("attack").isNull()).alias("missing_attack"))


@query("read_scoring_csv", oracle=f"""
WITH c AS ({CONNECTION_SQL})
SELECT service, count(*) AS n, CAST(sum(duration) AS BIGINT) AS duration, CAST(sum(hot) AS BIGINT) AS hot
FROM c WHERE split = 'test' GROUP BY service""")
def q_read_scoring_csv(spark, sf):
    """IO2 + IO5: headered CSV of records to score (features only)."""
    path = scratch_path(spark, f"scoring-{uuid.uuid4().hex}")
    recs = connection_records(spark, sf).where(F.col("split") == "test").select(*R.FEATURE_COLUMNS)
    K.write_csv(recs, path)
    s = R.read_scoring(spark, path)
    return s.groupBy("service").agg(F.count(F.lit(1)).alias("n"), F.sum("duration").cast("long").alias("duration"),
                                    F.sum("hot").cast("long").alias("hot"))
