"""ML8 as aggregates: Gaussian naive Bayes over an array column, SQL-checkable.

Per-class means and population variances come from one grouped aggregate
over the long form (class, feature, value); the stats table has
classes x features rows (bounded by the schema), so it is broadcast to the
test rows' long form."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import attach_row


def _long(df: DataFrame, key: str, vec: str, label: str | None):
    cols = [key] + ([label] if label else [])
    return df.select(*cols, F.posexplode(vec).alias("j", "x")).withColumn("x", F.col("x").cast("double"))


def fit_gaussian_nb(train: DataFrame, key: str, vec: str, label: str, var_smoothing: float = 1e-9):
    lt = _long(train, key, vec, label)
    st = lt.groupBy(label, "j").agg(F.avg("x").alias("mu"), F.var_pop("x").alias("var"))
    eps = lt.groupBy("j").agg(F.var_pop("x").alias("v")).agg((F.max("v") * var_smoothing).alias("eps"))
    pri = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    pri = pri.withColumn("log_prior", F.log(F.col("n_c") / F.sum("n_c").over(Window.partitionBy())))
    return attach_row(st, eps), pri.select(label, "log_prior")


def predict_gaussian_nb(test: DataFrame, model, key: str, vec: str, label: str) -> DataFrame:
    st, pri = model
    lt = _long(test, key, vec, None)
    v = F.col("var") + F.col("eps")
    j = lt.join(st, "j")
    ll = j.groupBy(key, label).agg(F.sum(-0.5 * F.log(2 * math.pi * v) - (F.col("x") - F.col("mu")) ** 2 / (2 * v)).alias("ll"))
    sc = ll.join(pri, label).withColumn("s", F.col("ll") + F.col("log_prior"))
    return sc.groupBy(key).agg(F.max_by(label, "s").alias("prediction"), (F.max("s") - F.min("s")).alias("margin"))
