"""Estimators and models of our own that fit into Spark's pipelines: they have params,
enter Pipeline and CrossValidator, and persist with PipelineModel.save. A model's
fitted state is a small table beside its metadata.

ML4 random forest, EN3 bagging, ML5 extra trees, ML6 gradient boosting, ML7 AdaBoost, ML9 discriminant analysis, ML10 leaf-wise boosting, ML11
ordered boosting, ML13 RBF-kernel SVM, ML15 forest regressor, EN1 voting, EN2 stacking."""

from __future__ import annotations

import json
import math
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..session import scratch_path
from . import boosting as BO
from . import trees as T


def materialised(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read again, so its lineage ends there."""
    import uuid
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- persistence -----------------------------------------------------------

class _Writer(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        rows, schema, more = self.model._state()
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"state": json.dumps(more)})
        if schema:
            spark.createDataFrame(rows, schema).write.parquet(f"{path}/state")
        for name, part in self.model._parts().items():
            part.write().overwrite().save(f"{path}/parts/{name}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        more = json.loads(meta["state"])
        rows = [r.asDict() for r in spark.read.parquet(f"{path}/state").collect()] if self.cls.TABLE else []
        model = self.cls._restored(rows, more, lambda name: DefaultParamsReader.loadParamsInstance(f"{path}/parts/{name}", spark))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class OwnModel(Model, HasFeaturesCol, HasLabelCol, MLReadable, MLWritable):
    """A fitted model whose state is a table (or other models) and a few numbers."""

    TABLE = True        # the state has table rows

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def _parts(self) -> dict:
        return {}

    def _like(self, estimator):
        """The column names of the estimator."""
        self._set(featuresCol=estimator.getFeaturesCol(), labelCol=estimator.getLabelCol())
        return self


class OwnEstimator(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Keyword arguments set params. Without weightCol all rows weigh 1."""

    def __init__(self, **params):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", seed=42, **self._defaults())
        self._set(**{k: v for k, v in params.items() if v is not None})

    def _defaults(self) -> dict:
        return {}

    def _of(self, name: str):
        return self.getOrDefault(name)

    def _weight(self):
        return F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) and self.getWeightCol() else F.lit(1.0)

    def _label(self):
        return F.col(self.getLabelCol()).cast("double")


def _int(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toInt)


def _float(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toFloat)


# ---- trees -----------------------------------------------------------------

class TreeModel(OwnModel):
    """Sum of trees. kind: "share" (score = mean leaf share of class 1), "logistic" (score = sigmoid of the sum),
    "vote" (score in [-1, 1], class by its sign) or "value" (regression)."""

    def __init__(self, ensemble: T.Ensemble | None = None, kind: str = "share", losses=()):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.ensemble, self.kind, self.losses = ensemble, kind, list(losses)

    def _transform(self, df: DataFrame) -> DataFrame:
        raw = self.ensemble.column(df, vector_to_array(self.getFeaturesCol()))
        if self.kind == "value":
            return df.withColumn("prediction", raw)
        out = df.withColumn("score", F.least(raw, F.lit(1.0)) if self.kind == "share" else raw)      # a sum of shares may round above 1
        if self.kind == "logistic":
            out = out.withColumn("score", 1 / (1 + F.exp(-F.col("score"))))
        return out.withColumn("prediction", (F.col("score") > (0.0 if self.kind == "vote" else 0.5)).cast("double"))

    def _state(self):
        e = self.ensemble
        return list(e.rows()), T.Ensemble.SCHEMA, {"kind": self.kind, "base": e.base, "scale": e.scale, "losses": self.losses}

    @classmethod
    def _restored(cls, rows, more, part):
        return cls(T.Ensemble.of(rows, more["base"], more["scale"]), more["kind"], more["losses"])


def _floats(b, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _class_sums(b, t) -> np.ndarray:
    y, w = _floats(b, "y"), _floats(b, "w")
    return np.stack([np.ones(len(y)), w * (1 - y), w * y], 1)


class ExtraTreesClassifier(OwnEstimator):
    """ML5: each node looks at sqrt(p) features at one random cut each; no bootstrap. `groups` passes grow the trees,
    so that the gathered rows of one pass are those of numTrees / groups trees."""

    numTrees, maxDepth = _int("numTrees", "trees"), _int("maxDepth", "levels below the root at most; 0: no limit")
    maxBins, groups, finish = _int("maxBins", "bins of a feature"), _int("groups", "passes"), _int("finish", "bytes of rows that one task finishes")

    def _defaults(self):
        return dict(numTrees=100, maxDepth=0, maxBins=255, groups=1, finish=T.FINISH)

    def _fit(self, df: DataFrame) -> TreeModel:
        bins = T.fit_bins(df, self._of("maxBins"), self.getFeaturesCol())
        table = T.binned(df, bins, self._label().alias("y"), self._weight().alias("w"), features=self.getFeaturesCol()).cache()
        try:
            p, n = len(bins.cuts), self._of("numTrees")
            rule = T.Rule("gini", tries=max(1, math.isqrt(p)), depth=self._of("maxDepth") or 1 << 30, seed=self.getSeed())
            rows = T.Rows(table, bins, _class_sums)
            root = T.root_sums(rows, [0])[0]
            groups = max(1, min(self._of("groups"), n))
            grown = []
            for g in range(groups):
                some = list(range(g * n // groups, (g + 1) * n // groups))
                grown += [t.tree(rule) for t in T.grow_forest(rows, rule, some, dict.fromkeys(some, root), self._of("finish"))]
        finally:
            table.unpersist()
        return TreeModel(T.Ensemble(bins, grown, 0.0, 1.0 / n), "share")._like(self)


class ForestRegressor(OwnEstimator):
    """ML15: bootstrapped variance trees over all features. A row's bootstrap counts hash its features and label (or
    the column keyCol), so they do not depend on the partitioning."""

    numTrees, maxDepth, minRows = _int("numTrees", "trees"), _int("maxDepth", "levels below the root at most; 0: no limit"), _int("minRows", "rows of a leaf at least")
    maxBins, groups, finish = _int("maxBins", "bins of a feature"), _int("groups", "passes"), _int("finish", "bytes of rows that one task finishes")
    keyCol = Param(Params._dummy(), "keyCol", "row id", typeConverter=TypeConverters.toString)

    def _defaults(self):
        return dict(numTrees=100, maxDepth=0, minRows=1, maxBins=64, groups=4, finish=T.FINISH)

    def _fit(self, df: DataFrame) -> TreeModel:
        bins = T.fit_bins(df, self._of("maxBins"), self.getFeaturesCol())
        ident = F.xxhash64(self._of("keyCol")) if self.isDefined("keyCol") else F.xxhash64(vector_to_array(self.getFeaturesCol()), self._label())
        table = T.binned(df, bins, self._label().alias("y"), ident.alias("id"), features=self.getFeaturesCol()).cache()
        seed = self.getSeed()

        def sums(b, t):
            y = _floats(b, "y")
            c = T.poisson(seed, t, np.ascontiguousarray(_floats(b, "id")))
            return np.stack([(c > 0).astype(np.float64), c, c * y], 1)
        try:
            n = self._of("numTrees")
            rule = T.Rule("variance", depth=self._of("maxDepth") or 1 << 30, least_rows=self._of("minRows"), seed=seed)
            rows = T.Rows(table, bins, sums)
            groups = max(1, min(self._of("groups"), n))
            grown = []
            for g in range(groups):
                some = list(range(g * n // groups, (g + 1) * n // groups))
                grown += [t.tree(rule) for t in T.grow_forest(rows, rule, some, T.root_sums(rows, some), self._of("finish"))]
        finally:
            table.unpersist()
        return TreeModel(T.Ensemble(bins, grown, 0.0, 1.0 / n), "value")._like(self)


class ForestClassifierModel(TreeModel):
    """ML4, EN3: the mean leaf share of class 1 as score and as `probability`; featureImportances: the mean over the trees
    of each one's gains by feature, as shares."""

    def __init__(self, ensemble: T.Ensemble | None = None, importances=()):
        super().__init__(ensemble, "share")
        self.importances = [float(v) for v in importances]

    @property
    def featureImportances(self):
        return Vectors.dense(self.importances)

    def _transform(self, df: DataFrame) -> DataFrame:
        return super()._transform(df).withColumn("probability", array_to_vector(F.array(1 - F.col("score"), F.col("score"))))

    def _state(self):
        rows, schema, more = super()._state()
        return rows, schema, {**more, "importances": self.importances}

    @classmethod
    def _restored(cls, rows, more, part):
        return cls(T.Ensemble.of(rows, more["base"], more["scale"]), more["importances"])


class ForestClassifier(OwnEstimator):
    """ML4 (and EN3 with featureSubsetStrategy "all"): bootstrapped gini trees; each node takes the best cut of sqrt(p)
    drawn features, and draws the next ones where none is worth a cut. A row's bootstrap counts hash its values, so they
    do not depend on the partitioning. The trees grow in passes that gather at most about `gathered` bytes of rows each."""

    numTrees, maxDepth = _int("numTrees", "trees"), _int("maxDepth", "levels below the root at most; 0: no limit")
    minInstancesPerNode, maxBins = _int("minInstancesPerNode", "rows of a leaf at least"), _int("maxBins", "bins of a feature")
    finish, gathered = _int("finish", "bytes of rows that one task finishes"), _int("gathered", "bytes of rows that a pass gathers")
    bootstrap = Param(Params._dummy(), "bootstrap", "draw the rows of each tree", typeConverter=TypeConverters.toBoolean)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "sqrt or all", typeConverter=TypeConverters.toString)

    def _defaults(self):
        return dict(numTrees=100, maxDepth=0, minInstancesPerNode=1, maxBins=64, finish=T.FINISH, gathered=1 << 30, bootstrap=True, featureSubsetStrategy="sqrt")

    def _fit(self, df: DataFrame) -> ForestClassifierModel:
        bins = T.fit_bins(df, self._of("maxBins"), self.getFeaturesCol())
        x = vector_to_array(self.getFeaturesCol())
        ident = F.xxhash64(x, *[F.col(f.name) for f in df.schema if isinstance(f.dataType, AtomicType)])
        table = T.binned(df, bins, self._label().alias("y"), self._weight().alias("w"), ident.alias("id"), features=self.getFeaturesCol()).cache()
        seed, draw = self.getSeed(), self._of("bootstrap")

        def sums(b, t):
            y, w = _floats(b, "y"), _floats(b, "w")
            c = T.poisson(seed, t, np.ascontiguousarray(_floats(b, "id"))) if draw else np.ones(len(y))
            w = w * c
            return np.stack([(c > 0).astype(np.float64), w * (1 - y), w * y], 1)
        try:
            p, n = len(bins.cuts), self._of("numTrees")
            tries = None if self._of("featureSubsetStrategy") == "all" else max(1, math.isqrt(p))
            rule = T.Rule("gini", tries=tries, best=True, depth=self._of("maxDepth") or 1 << 30, least_rows=self._of("minInstancesPerNode"), seed=seed)
            rows = T.Rows(table, bins, sums)
            roots = T.root_sums(rows, list(range(n)))
            size = sum(float(r[0]) for r in roots.values()) * (p + 24)
            groups = max(1, min(n, math.ceil(size / self._of("gathered"))))
            grown, shares = [], np.zeros(len(df.select(x.alias("x")).first().x) if roots else p)
            for g in range(groups):
                some = list(range(g * n // groups, (g + 1) * n // groups))
                for t in T.grow_forest(rows, rule, some, {t: roots.get(t, np.zeros(3)) for t in some}, self._of("finish")):
                    grown.append(t.tree(rule))
                    gains = t.gains(p)
                    if gains.sum() > 0:
                        shares[bins.keep] += gains / gains.sum()
        finally:
            table.unpersist()
        return ForestClassifierModel(T.Ensemble(bins, grown, 0.0, 1.0 / n), shares / (shares.sum() or 1.0))._like(self)


class AdaBoostClassifier(OwnEstimator):
    """ML7: SAMME with stumps. A row's weight is a function of the stumps so far, so the binned rows stay as they
    are and every round is one histogram pass; its error comes from the sums of the two leaves."""

    maxIter, stepSize, maxBins = _int("maxIter", "rounds"), _float("stepSize", "learning rate"), _int("maxBins", "bins of a feature")

    def _defaults(self):
        return dict(maxIter=50, stepSize=1.0, maxBins=64)

    def _fit(self, df: DataFrame) -> TreeModel:
        bins = T.fit_bins(df, self._of("maxBins"), self.getFeaturesCol())
        table = T.binned(df, bins, self._label().alias("y"), self._weight().alias("w"), features=self.getFeaturesCol()).cache()
        p, stumps, alphas = len(bins.cuts), [], []
        rule = T.Rule("gini", depth=1, seed=self.getSeed())

        def sums(b, t):
            y, w = _floats(b, "y"), _floats(b, "w").copy()
            x = T._bytes(b.column(b.schema.get_field_index("x")), p)
            for s, a in zip(stumps, alphas, strict=True):
                w *= np.exp(a * ((s.value[s.leaves(x)] > 0.5) != (y > 0.5)))
            return np.stack([np.ones(len(y)), w * (1 - y), w * y], 1)
        try:
            rows = T.Rows(table, bins, sums)
            root = T.root_sums(rows, [0])[0]
            for _ in range(self._of("maxIter")):
                if root[1] <= 0 or root[2] <= 0:
                    break
                nodes = T.grow_forest(rows, rule, [0], {0: root}, finish=0)[0]      # finish=0: always by a histogram pass
                s = np.array(nodes.sums)
                ends = s[1:] if len(s) > 1 else s
                error, total = np.minimum(ends[:, 1], ends[:, 2]).sum(), s[0, 1:].sum()
                if error >= 0.5 * total:
                    break
                alpha = self._of("stepSize") * math.log((total - error) / error) if error > 0 else 1.0
                stumps.append(nodes.tree(rule))
                alphas.append(alpha)
                if error <= 0:
                    break
                # the weights of missed rows grow by exp(alpha), so the next round's sums are known from these leaves
                missed = np.where(ends[:, 1] < ends[:, 2], ends[:, 1], 0).sum(), np.where(ends[:, 1] >= ends[:, 2], ends[:, 2], 0).sum()
                root = s[0] + np.array([0.0, *missed]) * (math.exp(alpha) - 1)
        finally:
            table.unpersist()
        votes = [T.Tree(s.feature, s.bin, s.left, np.where(s.value > 0.5, a, -a)) for s, a in zip(stumps, alphas, strict=True)]
        return TreeModel(T.Ensemble(bins, votes, 0.0, 1.0 / (sum(alphas) or 1.0)), "vote")._like(self)


def _log_loss(y, margin, w):
    return float((w * (np.logaddexp(0, margin) - y * margin)).sum())


def _newton_slopes(y, w, margin):
    """Gradient and Hessian of each row's loss."""
    q = 1 / (1 + np.exp(-margin))
    return w * (q - y), np.maximum(w * q * (1 - q), 1e-16)


def _residuals(y, w, margin):
    """Weight and weighted residual of each row."""
    return w, w * (y - 1 / (1 + np.exp(-margin)))


class _Boosting(OwnEstimator):
    """Shared by the boosted models: stages of Newton steps on the logistic loss over blocks of rows (`boosting`), whose margins
    are moved by each tree; rows of at most `finish` bytes are boosted by one task. With finish = 0 a stage is a few passes over the rows themselves: the margins of the stages so far are
    computed from the trees, and written beside the rows every `every` stages, so a stage looks at few trees."""

    maxIter, stepSize, maxBins = _int("maxIter", "stages"), _float("stepSize", "learning rate"), _int("maxBins", "bins of a feature")
    every, finish, l2 = _int("every", "stages between written margins"), _int("finish", "bytes of rows that one task finishes"), _float("l2", "added to the Hessian of a leaf")

    def _boost(self, table: DataFrame, bins: T.Bins, rule: T.Rule, grow=None, model=TreeModel) -> TreeModel:
        """`table`: y, w, x (bins). `grow(rows, root)` makes the nodes of one stage's tree by `rule` with finish = 0."""
        table, y, w = materialised(table, "boosting"), F.col("y"), F.col("w")
        n, pos, total = table.agg(F.count(F.lit(1)), F.sum(y * w), F.sum(w)).first()
        share = min(max((pos or 0.0) / (total or 1.0), 1e-6), 1 - 1e-6)
        base, step, p = math.log(share / (1 - share)), self._of("stepSize"), len(bins.cuts)
        finish = self._of("finish")
        if finish or grow is None:
            slopes = _residuals if rule.score == "variance" else _newton_slopes
            grown, losses = BO.boosted(table, bins, rule, n, n * (p + 24) <= finish, self._of("maxIter") if n else 0, self._of("every"), base, step, slopes, _log_loss,
                                       lambda df: materialised(df, "boosting"))
            return model(T.Ensemble(bins, grown, base, step), "logistic", [v / (total or 1.0) for v in losses])
        table = materialised(table.withColumn("m", F.lit(base)), "boosting").cache()
        grown, fresh, losses = [], [], []

        def margins(b):
            x = T._bytes(b.column(b.schema.get_field_index("x")), p)
            m = _floats(b, "m").copy()
            for t in fresh:
                m += step * t.value[t.leaves(x)]
            return m

        def sums(b, t):
            y, w = _floats(b, "y"), _floats(b, "w")
            return np.stack([np.ones(len(y)), *_newton_slopes(y, w, margins(b))], 1)

        def moved(batches):
            import pyarrow as pa
            for b in batches:
                yield b.set_column(b.schema.get_field_index("m"), "m", pa.array(margins(b)))

        def loss(batches):
            import pyarrow as pa
            out = 0.0
            for b in batches:
                out += _log_loss(_floats(b, "y"), margins(b), _floats(b, "w"))
            yield pa.RecordBatch.from_arrays([pa.array([out])], ["loss"])
        try:
            stage, last = 0, self._of("maxIter")
            while n and stage < last:
                rows = T.Rows(table, bins, sums)
                nodes = grow(rows, T.root_sums(rows, [0])[0])
                if nodes.feature[0] < 0:
                    break
                tree = nodes.tree(rule)
                grown.append(tree)
                fresh.append(tree)
                stage += 1
                if len(fresh) >= self._of("every") or stage == last:
                    next_ = materialised(table.mapInArrow(moved, table.schema), "boosting")
                    table.unpersist()
                    table = next_.cache()
                    fresh = []
                    losses.append(table.mapInArrow(loss, "loss double").agg(F.sum("loss")).first()[0] / (total or 1.0))
        finally:
            table.unpersist()
        return model(T.Ensemble(bins, grown, base, step), "logistic", losses)


class LeafwiseBoostingClassifier(_Boosting):
    """ML10: boosted trees grown best-first to numLeaves leaves on histograms; of two children only the smaller one is
    counted. Defaults: 31 leaves of 20 rows at least."""

    numLeaves, minRows = _int("numLeaves", "leaves of a tree"), _int("minRows", "rows of a leaf at least")

    def _defaults(self):
        return dict(maxIter=100, stepSize=0.1, maxBins=64, every=25, finish=T.FINISH, l2=0.0, numLeaves=31, minRows=20)

    def _fit(self, df: DataFrame) -> TreeModel:
        bins = T.fit_bins(df, self._of("maxBins"), self.getFeaturesCol())
        table = T.binned(df, bins, self._label().alias("y"), self._weight().alias("w"), features=self.getFeaturesCol())
        rule = T.Rule("newton", least_rows=self._of("minRows"), least_b=1e-3, l2=self._of("l2"), leaves=self._of("numLeaves"))
        return self._boost(table, bins, rule, lambda rows, root: T.grow_forest(rows, rule, [0], {0: root}, self._of("finish"))[0])._like(self)


class GradientBoostingModel(TreeModel):
    """ML6: `probability` besides."""

    def __init__(self, ensemble: T.Ensemble | None = None, kind: str = "logistic", losses=()):
        super().__init__(ensemble, kind, losses)

    def _transform(self, df: DataFrame) -> DataFrame:
        return super()._transform(df).withColumn("probability", array_to_vector(F.array(1 - F.col("score"), F.col("score"))))


class GradientBoostingClassifier(_Boosting):
    """ML6: in each stage a tree of the best cuts by the variance of the residuals, maxDepth levels deep, whose leaves are
    Newton steps on the logistic loss, as in the reference library."""

    maxDepth, minRows = _int("maxDepth", "levels of a tree"), _int("minRows", "rows of a leaf at least")

    def _defaults(self):
        return dict(maxIter=100, stepSize=0.1, maxBins=64, every=25, finish=T.FINISH, maxDepth=3, minRows=1)

    def _fit(self, df: DataFrame) -> GradientBoostingModel:
        number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)
        fine = F.forall(vector_to_array(self.getFeaturesCol()), number) & self._label().isin(0.0, 1.0) & number(self._weight())
        if df.where(~F.coalesce(fine, F.lit(False))).limit(1).count():
            raise ValueError("features and weights must be numbers that are finite, labels 0 or 1")     # as in Spark's own models
        bins = T.fit_bins(df, self._of("maxBins"), self.getFeaturesCol())
        table = T.binned(df, bins, self._label().alias("y"), self._weight().alias("w"), features=self.getFeaturesCol())
        return self._boost(table, bins, T.Rule("variance", depth=self._of("maxDepth"), least_rows=self._of("minRows")), model=GradientBoostingModel)._like(self)


# ---- ordered target statistics -----------------------------------------------

def ordered_statistics(df: DataFrame, cols: list[str], label: str, order: str, prior: float, strength: float = 1.0, buckets: int = 256) -> DataFrame:
    """Adds `<col>_ts`: (positive labels before the row in its category + strength * prior) / (rows before it + strength), in
    the hashed order of `order` (a 64-bit hash); rows of equal hash do not see each other. Categories are cut into
    `buckets` ranges of the order, so that one which holds most rows is summed by many tasks."""
    from pyspark.sql import Window as W
    for c in cols:
        cat, n, s = f"__{c}", "__n", "__s"
        df = df.withColumn(cat, F.coalesce(F.col(c).cast("string"), F.lit("\0"))).withColumn("__top", F.pmod(F.shiftright(F.col(order), 48), F.lit(65536)))
        df = df.withColumn("__b", F.floor(F.col("__top") * buckets / 65536))
        sizes = df.groupBy(cat, "__b").agg(F.count(F.lit(1)).alias("__bn"), F.sum(label).alias("__bs"))
        before = W.partitionBy(cat).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)             # at most `buckets` rows of a category
        sizes = sizes.select(cat, "__b", F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias(n), F.coalesce(F.sum("__bs").over(before), F.lit(0.0)).alias(s))
        inside = W.partitionBy(cat, "__b").orderBy("__top", F.pmod(F.col(order), F.lit(1 << 48)))
        upto, peers = inside.rangeBetween(W.unboundedPreceding, W.currentRow), inside.rangeBetween(W.currentRow, W.currentRow)
        df = (df.withColumn("__in", F.count(F.lit(1)).over(upto) - F.count(F.lit(1)).over(peers)).withColumn("__is", F.sum(label).over(upto) - F.sum(label).over(peers))
              .join(sizes, [cat, "__b"]))
        df = df.withColumn(f"{c}_ts", (F.col(s) + F.col("__is") + strength * prior) / (F.col(n) + F.col("__in") + strength)).drop(cat, "__top", "__b", n, s, "__in", "__is")
    return df


class OrderedBoostingModel(OwnModel):
    """Boosted symmetric trees over a numeric vector and categorical columns; a category's statistic at scoring time
    counts all training rows, an unknown one has the prior."""

    def __init__(self, trees: TreeModel | None = None, cats=(), values=(), prior: float = 0.5):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.trees, self.cats, self.values, self.prior = trees, list(cats), list(values), prior
        self.losses = trees.losses if trees else []

    def encoded(self, df: DataFrame) -> DataFrame:
        """`df` with `__x`, the features and the statistics of the categories. The statistics are a table; whether it is
        broadcast is left to its size."""
        spark = df.sparkSession
        stats = spark.createDataFrame(self.values, "col string, value string, ts double")
        added = []
        for i, c in enumerate(self.cats):
            some = stats.where(F.col("col") == c).select(F.col("value").alias(f"__v{i}"), F.col("ts").alias(f"__t{i}"))
            df = df.join(some, F.coalesce(F.col(c).cast("string"), F.lit("\0")) == F.col(f"__v{i}"), "left")
            added.append(F.coalesce(F.col(f"__t{i}"), F.lit(self.prior)))
        x = F.concat(vector_to_array(self.getFeaturesCol()), F.array(*added)) if added else vector_to_array(self.getFeaturesCol())
        return df.withColumn("__x", x).drop(*[f"__{k}{i}" for i in range(len(self.cats)) for k in "vt"])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.encoded(df)
        score = 1 / (1 + F.exp(-self.trees.ensemble.column(df, F.col("__x"))))
        return out.withColumn("score", score).withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop("__x")

    def _state(self):
        return [tuple(v) for v in self.values], "col string, value string, ts double", {"cats": self.cats, "prior": self.prior}

    def _parts(self):
        return {"trees": self.trees}

    @classmethod
    def _restored(cls, rows, more, part):
        return cls(part("trees"), more["cats"], [(r["col"], r["value"], r["ts"]) for r in rows], more["prior"])


class OrderedBoostingClassifier(_Boosting):
    """ML11: boosting of symmetric trees (one split for all nodes of a level) over numeric features and raw categorical
    columns. In training a row's category counts by the rows before it in a hashed order, so its statistic never holds its
    own label. Leaves are regularised by l2 = 3."""

    maxDepth = _int("maxDepth", "levels of a tree")
    catCols = Param(Params._dummy(), "catCols", "categorical columns", typeConverter=TypeConverters.toListString)
    keyCol = Param(Params._dummy(), "keyCol", "row id, whose hash is the order of the statistics", typeConverter=TypeConverters.toString)

    def _defaults(self):
        return dict(maxIter=100, stepSize=0.1, maxBins=64, every=25, finish=T.FINISH, l2=3.0, maxDepth=6, catCols=[])

    def _fit(self, df: DataFrame) -> OrderedBoostingModel:
        from pyspark.ml.functions import array_to_vector
        cats, x = self._of("catCols"), vector_to_array(self.getFeaturesCol())
        ident = F.xxhash64(self._of("keyCol"), F.lit(self.getSeed())) if self.isDefined("keyCol") else F.xxhash64(x, *cats, F.lit(self.getSeed()))
        rows = df.select(x.alias("__x"), *[F.col(c).cast("string").alias(c) for c in cats], self._label().alias("y"), self._weight().alias("w"), ident.alias("__o"))
        prior = rows.agg(F.avg("y")).first()[0]
        prior = 0.5 if prior is None else prior
        seen = materialised(ordered_statistics(rows, cats, "y", "__o", prior) if cats else rows, "ordered")
        vec = F.concat("__x", F.array(*[F.col(f"{c}_ts") for c in cats])) if cats else F.col("__x")
        seen = seen.select("y", "w", array_to_vector(vec).alias("features"))
        bins = T.fit_bins(seen, self._of("maxBins"))
        rule = T.Rule("newton", l2=self._of("l2"), depth=self._of("maxDepth"), symmetric=True)
        model = self._boost(T.binned(seen, bins, F.col("y"), F.col("w")), bins, rule, lambda r, root: T.grow_symmetric_tree(r, rule, root, self._of("finish")))
        values = []
        for c in cats:      # a row for each category: part of the model, as the categories of a one-hot encoding are
            ts = (F.sum("y") + prior) / (F.count(F.lit(1)) + 1)
            values += [(c, r[0], r[1]) for r in rows.groupBy(F.coalesce(F.col(c), F.lit("\0")).alias("v")).agg(ts.alias("ts")).orderBy("v").collect()]
        return OrderedBoostingModel(model, cats, values, prior)._like(self)


# ---- discriminant, kernel, ensembles ---------------------------------------

class LinearDiscriminantModel(OwnModel):
    """ML9: decision = w . x + b."""

    def __init__(self, w=(), b: float = 0.0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.w, self.b = [float(v) for v in w], float(b)

    def _transform(self, df: DataFrame) -> DataFrame:
        wl = F.array(*[F.lit(v) for v in self.w])
        dot = F.aggregate(F.zip_with(vector_to_array(self.getFeaturesCol()), wl, lambda a, c: a * c), F.lit(0.0), lambda acc, v: acc + v)
        return (df.withColumn("decision", dot + F.lit(self.b)).withColumn("score", 1 / (1 + F.exp(-F.col("decision"))))
                .withColumn("prediction", (F.col("decision") > 0).cast("double")))

    def _state(self):
        return [(i, v) for i, v in enumerate(self.w)], "i int, w double", {"b": self.b}

    @classmethod
    def _restored(cls, rows, more, part):
        return cls([r["w"] for r in sorted(rows, key=lambda r: r["i"])], more["b"])


class LinearDiscriminant(OwnEstimator):
    """ML9 as an estimator."""

    tol = _float("tol", "singular values below this share of the largest count as zero")

    def _defaults(self):
        return dict(tol=1e-4)

    def _fit(self, df: DataFrame) -> LinearDiscriminantModel:
        from .custom import fit_lda
        return fit_lda(df.select(F.col(self.getFeaturesCol()).alias("features"), self._label().alias("label")), self._of("tol"))._like(self)


class LogisticModel(LinearDiscriminantModel):
    """ML1 fitted by `LogisticTogether`: `probability` besides."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return super()._transform(df).withColumn("probability", array_to_vector(F.array(1 - F.col("score"), F.col("score"))))


class LogisticTogether(OwnEstimator):
    """ML1 for searches: L2 logistic regression, whose settings of one set of rows are fitted in the same passes (fitMultiple)
    and keep no copies of the rows in memory."""

    regParam, maxIter, tol = _float("regParam", "L2 penalty of the mean loss"), _int("maxIter", "steps"), _float("tol", "ends when steps gain under this share")

    def _defaults(self):
        return dict(regParam=0.0, maxIter=100, tol=1e-6)

    def _fitted(self, df: DataFrame, estimators: list) -> list[LogisticModel]:
        from . import linear as LI
        p = len(df.select(self.getFeaturesCol()).first()[0])
        table = materialised(LI.rows_of(df, self._label(), self._weight(), self.getFeaturesCol()), "rows")
        found = LI.fit_together(LI.Passes(table, p, p, LI.logistic_loss), [(e._of("regParam"), e._of("maxIter"), e._of("tol")) for e in estimators])
        return [LogisticModel(w, c)._like(e) for e, (w, c) in zip(estimators, found, strict=True)]

    def _fit(self, df: DataFrame) -> LogisticModel:
        return self._fitted(df, [self])[0]

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        if any(p.name not in ("regParam", "maxIter", "tol") for m in paramMaps for p in m):
            return super().fitMultiple(dataset, paramMaps)          # other columns
        return enumerate(self._fitted(dataset, [self.copy(m) for m in paramMaps]))


class FourierSVCModel(OwnModel):
    """ML13: a linear SVM over random Fourier features cos(x W + b)."""

    def __init__(self, W=None, b=None, w=None, c: float = 0.0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.W, self.b, self.w, self.c = W, b, w, float(c)

    def _transform(self, df: DataFrame) -> DataFrame:
        from .custom import rff_margin
        out = df.withColumn("score", rff_margin(df, self.W, self.b, self.w, self.c, self.getFeaturesCol()))
        return out.withColumn("prediction", F.when(F.isnan("score"), 0.0).otherwise((F.col("score") > 0).cast("double")))

    def _state(self):
        rows = zip(self.b, self.W.T, self.w, strict=True)
        return [(i, float(b), [float(v) for v in col], float(w)) for i, (b, col, w) in enumerate(rows)], "i int, b double, col array<double>, w double", {"c": self.c}

    @classmethod
    def _restored(cls, rows, more, part):
        rows = sorted(rows, key=lambda r: r["i"])
        return cls(np.array([r["col"] for r in rows]).T, np.array([r["b"] for r in rows]), np.array([r["w"] for r in rows]), more["c"])


class FourierSVC(OwnEstimator):
    """ML13 as an estimator."""

    components, C, maxIter = _int("components", "Fourier features"), _float("C", "inverse regularisation"), _int("maxIter", "iterations")

    def _defaults(self):
        return dict(components=200, C=1.0, maxIter=100)

    def _fit(self, df: DataFrame) -> FourierSVCModel:
        from .custom import fit_rbf_svc
        d = df.select(F.col(self.getFeaturesCol()).alias("features"), self._label().alias("label"))
        return fit_rbf_svc(d, self._of("components"), self._of("C"), self._of("maxIter"), self.getSeed())._like(self)


class VotingModel(OwnModel):
    """EN1: the majority of the members' predictions; ties go to class 0."""

    TABLE = False

    def __init__(self, members: dict | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.members = members or {}

    def _transform(self, df: DataFrame) -> DataFrame:
        from .ensembles import _beside
        out = df
        for n, m in self.members.items():
            out = _beside(m, out, {"prediction": f"__pred_{n}"})
        votes = reduce(lambda a, b: a + b, [F.col(f"__pred_{n}") for n in self.members])
        return out.withColumn("prediction", (votes * 2 > len(self.members)).cast("double")).drop(*[f"__pred_{n}" for n in self.members])

    def _state(self):
        return [], "", {"names": list(self.members)}

    def _parts(self):
        return self.members

    @classmethod
    def _restored(cls, rows, more, part):
        return cls({n: part(n) for n in more["names"]})


class StackingModel(OwnModel):
    """EN2: a logistic regression over the members' scores of class 1."""

    TABLE = False

    def __init__(self, bases: dict | None = None, meta: LogisticRegressionModel | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.bases, self.meta = bases or {}, meta

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        from .ensembles import _beside
        out = df
        for n, m in self.bases.items():
            out = _beside(m, out, {"score": f"__s_{n}"})
        x = out.withColumn("__z", array_to_vector(F.array(*[F.col(f"__s_{n}") for n in self.bases])))
        y = self.meta.setFeaturesCol("__z").transform(x).withColumn("score", vector_to_array("probability")[1])
        return y.drop("__z", *[f"__s_{n}" for n in self.bases])

    def _state(self):
        return [], "", {"names": list(self.bases)}

    def _parts(self):
        return {**self.bases, "__meta": self.meta}

    @classmethod
    def _restored(cls, rows, more, part):
        return cls({n: part(n) for n in more["names"]}, part("__meta"))
