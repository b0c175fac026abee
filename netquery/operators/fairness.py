"""Shared-link measures over a per-step flow history (AG12-AG18, PR10).

history(scenario, t, client, throughput, rtt_ms, cwnd, drops): one row per
(scenario, step, client) once densified; every metric is a grouped
aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import classify_flow, safe_div
from .ordered import attach_row


def densify(df: DataFrame, step: str = "t", keys=("client",), by=("scenario",),
            values=("throughput", "drops"), fill=0) -> DataFrame:
    """AG18: every key of a scenario gets every step between the scenario's
    first and last step; missing values become `fill`. The grid is built by
    exploding a per-key step sequence (rows = steps x keys, the dense output
    itself), then left-joined with the sparse history: no cross join."""
    by, keys = list(by), list(keys)
    rng = df.groupBy(*by).agg(F.min(step).alias("__lo"), F.max(step).alias("__hi"))
    ks = df.select(*by, *keys).distinct()
    grid = (ks.join(rng, by) if by else attach_row(ks, rng)).select(
        *by, *keys, F.explode(F.sequence("__lo", "__hi")).alias(step))
    out = grid.join(df, [*by, step, *keys], "left")
    return out.fillna({v: fill for v in values if v in df.columns})


def jain(df: DataFrame, x: str = "throughput", by=("scenario", "t")) -> DataFrame:
    """AG12: J = (sum x)^2 / (n * sum x^2) per step, 0 when all are zero; n = all clients."""
    by = list(by)
    a = df.groupBy(*by).agg(F.sum(F.col(x).cast("double")).alias("s"),
                            F.sum(F.col(x).cast("double") * F.col(x).cast("double")).alias("s2"),
                            F.count(F.lit(1)).alias("n"))
    return a.select(*by, F.when(F.col("s2") > 0, safe_div(F.col("s") * F.col("s"), F.col("n") * F.col("s2")))
                    .otherwise(F.lit(0.0)).alias("jain"))


def jain_mean(j: DataFrame, by=("scenario",)) -> DataFrame:
    """AG13: mean of the per-step index over time."""
    return j.groupBy(*by).agg(F.avg("jain").alias("jain_mean"))


def drops_by_algorithm(df: DataFrame, client: str = "client", drops: str = "drops",
                       by=("scenario",)) -> DataFrame:
    """AG14: total drops per algorithm; unmatched clients and zero totals hidden."""
    by = list(by)
    a = (df.withColumn("algorithm", classify_flow(client)).where(F.col("algorithm").isNotNull())
         .groupBy(*by, "algorithm").agg(F.sum(drops).cast("long").alias("drops")))
    return a.where(F.col("drops") > 0)


def mean_throughput(df: DataFrame, client: str = "client", x: str = "throughput",
                    by=("scenario",)) -> DataFrame:
    """AG15: X_i = (1/T) sum_t x_i(t) over the dense series."""
    return df.groupBy(*by, client).agg(F.avg(F.col(x).cast("double")).alias("mean_throughput"))


def rtt_by_algorithm(df: DataFrame, client: str = "client", rtt: str = "rtt_ms",
                     by=("scenario",)) -> DataFrame:
    """AG16: mean RTT per algorithm."""
    return (df.withColumn("algorithm", classify_flow(client)).where(F.col("algorithm").isNotNull())
            .groupBy(*by, "algorithm").agg(F.avg(rtt).alias("mean_rtt_ms")))


def flow_step_counts(packets: DataFrame, step: str = "t", client: str = "client",
                     served: str = "served", by=("scenario",)) -> DataFrame:
    """AG17: per client and step, packets attempted, served and dropped."""
    return packets.groupBy(*by, step, client).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col(served)).alias("served"),
        F.count_if(~F.col(served)).alias("dropped"))
