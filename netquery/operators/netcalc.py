"""AG19 path delay over a hop table and AG20 overload fraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def path_delay(hops: DataFrame, path: str = "path_id", bits: str = "bits", rate: str = "rate_bps",
               dist: str = "dist_m", speed: str = "speed_mps") -> DataFrame:
    """Store-and-forward delay of a path: sum L/R (transmission) + sum d/s (propagation)."""
    h = hops.select(path, (F.col(bits) / F.col(rate)).alias("tr"), (F.col(dist) / F.col(speed)).alias("pr"))
    a = h.groupBy(path).agg(F.sum("tr").alias("transmission_s"), F.sum("pr").alias("propagation_s"),
                            F.count(F.lit(1)).alias("hops"))
    return a.withColumn("total_s", F.col("transmission_s") + F.col("propagation_s"))


def overload_fraction(steps: DataFrame, load: str = "load", capacity=None, by=()) -> DataFrame:
    """Share of steps whose offered load exceeds the link capacity."""
    cap = F.col(capacity) if isinstance(capacity, str) else F.lit(capacity)
    by = list(by)
    g = steps.groupBy(*by) if by else steps
    return g.agg(F.avg((F.col(load) > cap).cast("double")).alias("overload_fraction"),
                 F.count(F.lit(1)).alias("steps"))
