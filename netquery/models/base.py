"""Preprocessing pipeline, score extraction and evaluation shared by models.

The fitted preprocessing (category index + one-hot, population-std scaling,
assembly) is a PipelineModel, so it persists and reloads with the classifier
(unlike a bare classifier that needs hand-made inputs)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import attack_label
from ..operators import features as FE
from ..operators import metrics as M
from ..operators.ordered import attach_row
from ..operators.stats import with_class_weights
from ..sources.readers import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
from .own import materialised

NUMERIC_FEATURES = [c for c in FEATURE_COLUMNS if c not in CATEGORICAL_COLUMNS]


def scaler_stage(params: dict[str, tuple[float, float]], prefix: str = "__s_") -> SQLTransformer:
    """FE2/FE3 as a persistable stage: (x - mean) / std with fitted constants."""
    cols = ", ".join(f"(CAST(`{c}` AS DOUBLE) - {m!r}) / {s!r} AS `{prefix}{c}`" for c, (m, s) in params.items())
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def fit_preprocessing(train: DataFrame, numeric=None, cats=None, with_mean: bool = False) -> PipelineModel:
    numeric = list(numeric if numeric is not None else NUMERIC_FEATURES)
    cats = list(cats if cats is not None else CATEGORICAL_COLUMNS)
    params = FE.scale_fit(train, numeric, with_mean=with_mean)
    stages = FE.ml_one_hot_stages(cats) if cats else []
    stages += [scaler_stage(params),
               VectorAssembler(inputCols=[f"__s_{c}" for c in numeric] + [f"{c}_vec" for c in cats],
                               outputCol="features", handleInvalid="keep")]
    return Pipeline(stages=stages).fit(train)


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    pre: PipelineModel
    n_features: int

    def release(self):
        self.train.unpersist()
        self.test.unpersist()


def prepare(records: DataFrame, key: str = "conn_id", split: str = "split", balanced: bool = False,
            numeric=None, cats=None, with_mean: bool = False, label_col: str | None = None,
            partitions: int | None = None, keep: tuple[str, ...] = (), partition_rows: int = 250_000) -> Prepared:
    """Label (PR1), encode, scale on train only, assemble; cache both vectors, with the columns `keep`.

    The records are written once to the shared folder, so that what made them (a join,
    say) runs once and not for each pass of the fits. `partitions` deals them by key to so
    many partitions, and to more where one would hold over `partition_rows` rows. A forest's
    bootstrap depends on the partitioning, so a given number makes fits equal on
    any machine; None keeps the partitions of the written records."""
    df = materialised(records.withColumn("label", attack_label("attack") if label_col is None else F.col(label_col)), "records")
    train = df.where(F.col(split) == "train")
    test = df.where(F.col(split) == "test")
    pre = fit_preprocessing(train, numeric, cats, with_mean)

    def vectors(part):
        if partitions:          # dealt as records: they are smaller than their vectors
            part = part.repartition(max(partitions, math.ceil(part.count() / partition_rows)), key)
        return pre.transform(part).select(key, *keep, "features", F.col("label").cast("double").alias("label"))
    tr, te = vectors(train), vectors(test)
    if balanced:
        tr = with_class_weights(tr, "label", "weight", train.select(F.col("label").cast("double").alias("label")))
    else:
        tr = tr.withColumn("weight", F.lit(1.0))
    tr, te = tr.cache(), te.cache()
    n = len(tr.select("features").first()["features"]) if tr.take(1) else 0
    return Prepared(tr, te, pre, n)


def with_score(pred: DataFrame, kind: str) -> DataFrame:
    """Score rule: probability of class 1 if available, else the decision value."""
    if kind == "probability":
        return pred.withColumn("score", vector_to_array("probability")[1])
    if kind == "raw":
        return pred.withColumn("score", vector_to_array("rawPrediction")[1])
    return pred.withColumn("score", F.lit(None).cast("double"))


def evaluate(pred: DataFrame, name: str, has_score: bool = True, cells: bool = False) -> DataFrame:
    """One leaderboard row: model, accuracy, precision, recall, f1, roc_auc; with `cells` also the confusion cells tp, fp, fn, tn."""
    p = pred.select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
                    *(["score"] if has_score else []))
    m = M.binary_metrics(p).select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1", *(["tp", "fp", "fn", "tn"] if cells else []))
    if has_score:
        return attach_row(m, M.roc_auc(p))
    return m.withColumn("roc_auc", F.lit(None).cast("double"))


def n_weight(df: DataFrame) -> float:
    return float(df.agg(F.sum("weight")).first()[0] or 1.0)
