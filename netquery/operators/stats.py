"""EDA statistics: value counts (AG1), class balance (AG2), histogram (AG3),
box statistics (AG4) and balanced class weights (AG23)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import attach_row, running_sum


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AG1: count per value, descending (value as tie-break)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(col))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """AG2: count and share per class (the window runs over the k class rows)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """AG3: equal-width bins on [min, max]; the maximum falls in the last bin.
    Returns bin (1..bins), lower/upper edge and count of non-empty bins."""
    rng = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    x = attach_row(df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull()), rng)
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins)))
    g = x.groupBy(b.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    return g.select("bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
                    (F.col("lo") + F.col("bin") * width).alias("upper"), "count")


def value_counts_by(df: DataFrame, col: str, by=()) -> DataFrame:
    """(group..., __v, __n): the non-null values of `col` with their counts
    (partial aggregation: a hot group collapses to its distinct values)."""
    v = F.col(col).cast("double")
    return df.where(v.isNotNull()).groupBy(*by, v.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))


def quantiles_from_counts(g: DataFrame, probs, by=()) -> DataFrame:
    """Exact linear-interpolation quantiles from (group, __v, __n) rows:
    positions come from the bucketed running count, and each quantile is two
    conditional minima over the rows, so no group is gathered into one task."""
    by = list(by)
    g = running_sum(g, "__v", ["__n"], by=by, suffix="_cum")            # positions < __n_cum
    tot = g.groupBy(*by).agg(F.sum("__n").alias("__total"))
    g = g.join(tot, by) if by else attach_row(g, tot)
    aggs = []
    for i, p in enumerate(probs):
        r = F.lit(float(p)) * (F.col("__total") - 1)
        lo, hi = F.floor(r), F.ceil(r)
        aggs += [F.min(F.when(F.col("__n_cum") > lo, F.col("__v"))).alias(f"__lo{i}"),
                 F.min(F.when(F.col("__n_cum") > hi, F.col("__v"))).alias(f"__hi{i}"),
                 F.first(r - lo).alias(f"__fr{i}")]
    a = (g.groupBy(*by) if by else g).agg(*aggs, F.first("__total").alias("n"))
    return a.select(*by, "n", *[(F.col(f"__lo{i}") + F.col(f"__fr{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}")))
                                .alias(f"q{i}") for i in range(len(probs))])


def exact_quantiles(df: DataFrame, col: str, probs, by=()) -> DataFrame:
    """Exact quantiles per group (columns q0, q1, ... and n)."""
    return quantiles_from_counts(value_counts_by(df, col, by), probs, by)


def box_stats(df: DataFrame, by: str, col: str, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """AG4: quartiles (linear interpolation), 1.5*IQR whiskers (furthest data
    inside the fences) and the outlier count, per class. Quartiles and
    whiskers both come from the (class, value, count) table, so the input is
    scanned once. `approx=True` uses percentile_approx (a bounded sketch)."""
    g = value_counts_by(df, col, [by])
    if approx:
        q = df.groupBy(by).agg(F.percentile_approx(F.col(col).cast("double"), [0.25, 0.5, 0.75], accuracy).alias("qs"),
                               F.count(col).alias("n"))
        q = q.select(by, "n", F.col("qs")[0].alias("q0"), F.col("qs")[1].alias("q1"), F.col("qs")[2].alias("q2"))
    else:
        q = quantiles_from_counts(g, [0.25, 0.5, 0.75], [by])
    q = q.select(by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * iqr).withColumn("hi_fence", F.col("q3") + 1.5 * iqr)
    x = g.join(q.select(by, "lo_fence", "hi_fence"), by)
    inside = (F.col("__v") >= F.col("lo_fence")) & (F.col("__v") <= F.col("hi_fence"))
    w = x.groupBy(by).agg(F.min(F.when(inside, F.col("__v"))).alias("lower_whisker"),
                          F.max(F.when(inside, F.col("__v"))).alias("upper_whisker"),
                          F.sum(F.when(~inside, F.col("__n")).otherwise(0)).cast("long").alias("outliers"))
    return q.join(w, by).select(by, "n", "q1", "median", "q3", "lower_whisker", "upper_whisker", "outliers")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """AG23: balanced weights n / (k * n_c), one row per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    whole = Window.partitionBy()
    return c.select(label, "n_c", (F.sum("n_c").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n_c")))
                    .alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight", labels: DataFrame | None = None) -> DataFrame:
    """Attach the balanced weight as a weightCol. The weight table has one row per class and is
    broadcast: a shuffle by label would move all rows into a task for each class. `labels`: a frame with the
    same labels that is cheaper to count."""
    w = class_weights(df if labels is None else labels, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left")
