"""The tree grower against plain recursive growers, its two routes against each other, ordered statistics, and
persistence of the library's own models."""

import math
import random
import uuid
from functools import lru_cache

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from netquery.models import ensembles as EN
from netquery.models import own as O
from netquery.models import trees as T
from netquery.models import tuning as TU
from netquery.models.workflow import Candidate, run_detection
from netquery.session import scratch_path

P = 5


@lru_cache
def rows(n=240, seed=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x = [float(r.randrange(4)), float(r.randrange(30)), r.random(), float(r.random() < 0.2), 7.0]
        y = float((x[1] > 14) != (x[0] == 2) or r.random() < 0.1)
        out.append((i, *x, r.choice("abc") if i % 3 else "a", y, float(1 + i % 2), x[1] * 2 + x[0] ** 2 + round(r.random(), 3)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    cols = [f"x{j}" for j in range(P)]
    df = spark.createDataFrame(rows(), ["id", *cols, "cat", "label", "weight", "target"]).repartition(5, "id")
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df).cache()


def matrix(bins):
    return bins.of(np.array([r[1:1 + P] for r in rows()]))


def scores(model, data, col="score"):
    return [r[0] for r in model.transform(data).orderBy("id").select(col).collect()]


# ---- brute force ------------------------------------------------------------

def brute_extra_tree(x, s, bins, rule, tree, path, depth=0):
    """Leaf shares of class 1 by row index, one node at a time."""
    def grow(idx, path):
        a, b = s[idx, 1].sum(), s[idx, 2].sum()
        leaf = {i: b / (a + b) for i in idx}
        if a <= 0 or b <= 0 or len(idx) < 2:
            return leaf
        order = sorted(range(x.shape[1]), key=lambda f: int(T._draw(rule.seed, tree, np.array([path], np.uint64), np.array([f]))[0]))
        for at in range(0, x.shape[1], rule.tries):
            best = None
            for f in order[at:at + rule.tries]:
                v = x[idx, f]
                if v.min() == v.max():
                    continue
                u = float(T._unit(T._draw(rule.seed ^ 0x5A5A, tree, np.array([path], np.uint64), np.array([f])))[0])
                lo, hi = bins.cuts[f][v.min()], bins.cuts[f][v.max() - 1]
                cut = min(max(sum(c < lo + u * (hi - lo) for c in bins.cuts[f]), v.min()), v.max() - 1)
                sides = [idx[v <= cut], idx[v > cut]]
                gain = sum((s[i, 1].sum() ** 2 + s[i, 2].sum() ** 2) / (s[i, 1].sum() + s[i, 2].sum()) for i in sides)
                if best is None or gain > best[0] + 1e-12:
                    best = gain, sides
            if best:
                return {**grow(best[1][0], (path * 2 + 1) % (1 << 64)), **grow(best[1][1], (path * 2 + 2) % (1 << 64))}
        return leaf
    got = grow(np.arange(len(x)), path)
    return np.array([got[i] for i in range(len(x))])


def brute_best(x, g, h, idx, bins, least):
    """(gain, feature, bin) by trying every cut."""
    part = lambda i: g[i].sum() ** 2 / h[i].sum()
    best = None
    for f in range(x.shape[1]):
        for cut in range(len(bins.cuts[f])):
            a, b = idx[x[idx, f] <= cut], idx[x[idx, f] > cut]
            if len(a) >= least and len(b) >= least:
                gain = part(a) + part(b) - part(idx)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, f, cut
    return best


def brute_boost(x, y, bins, stages, leaves, least, step, base):
    m = np.full(len(y), base)
    for _ in range(stages):
        q = 1 / (1 + np.exp(-m))
        g, h = q - y, q * (1 - q)
        parts = [np.arange(len(y))]
        while len(parts) < leaves:
            best = max(((*b, k) for k, idx in enumerate(parts) if (b := brute_best(x, g, h, idx, bins, least))), default=None, key=lambda c: c[0])
            if best is None:
                break
            _, f, cut, k = best
            idx = parts.pop(k)
            parts += [idx[x[idx, f] <= cut], idx[x[idx, f] > cut]]
        for idx in parts:
            m[idx] -= step * g[idx].sum() / h[idx].sum()
    return 1 / (1 + np.exp(-m))


# ---- tests -------------------------------------------------------------------

@pytest.mark.parametrize("finish", [0, 2500, T.FINISH])
def test_extra_trees_equal_brute_force(data, finish):
    """Grown by histogram passes alone, by passes and tasks, and by tasks alone."""
    m = O.ExtraTreesClassifier(numTrees=3, maxBins=16, seed=9, weightCol="weight", finish=finish, groups=2).fit(data)
    x, w, y = matrix(m.ensemble.bins), np.array([r[8] for r in rows()]), np.array([r[7] for r in rows()])
    s = np.stack([np.ones(len(y)), w * (1 - y), w * y], 1)
    rule = T.Rule("gini", tries=2, seed=9)
    want = np.mean([brute_extra_tree(x, s, m.ensemble.bins, rule, t, 0) for t in range(3)], axis=0)
    assert np.allclose(scores(m, data), want)


def test_cuts_differ_between_nodes(data):
    m = O.ExtraTreesClassifier(numTrees=4, maxBins=64).fit(data)
    cuts = {(int(f), int(b)) for t in m.ensemble.trees for f, b in zip(t.feature, t.bin, strict=True) if f == 2}
    assert len(cuts) > 10
    assert len({tuple(t.bin) for t in m.ensemble.trees}) == 4


@pytest.mark.parametrize("finish", [0, 3000])
def test_forest_regressor_routes_agree_and_learn(data, finish):
    d = data.select("id", "features", F.col("target").alias("label"))
    make = lambda **kw: O.ForestRegressor(numTrees=4, maxBins=32, seed=3, keyCol="id", **kw).fit(d)
    a, b = make(), make(finish=finish, groups=1)
    assert np.allclose(scores(a, d, "prediction"), scores(b, d, "prediction"))
    y = np.array([r[9] for r in rows()])
    p = np.array(scores(a, d, "prediction"))
    assert ((y - p) ** 2).mean() < 0.05 * y.var()
    shallow = make(maxDepth=2)
    assert all(len(t.feature) <= 7 for t in shallow.ensemble.trees) and not np.allclose(scores(shallow, d, "prediction"), p)


def test_bootstrap_counts_are_poisson_and_independent_of_partitions():
    c = T.poisson(5, 3, np.random.default_rng(0).integers(-2**63, 2**63 - 1, 200_000))
    assert abs(c.mean() - 1) < 0.02 and abs(c.var() - 1) < 0.03 and abs((c == 0).mean() - math.exp(-1)) < 0.01


@pytest.mark.parametrize("finish", [0, 4000, T.FINISH])
def test_two_leafwise_stages_equal_brute_force(data, finish):
    m = O.LeafwiseBoostingClassifier(maxIter=2, stepSize=0.5, numLeaves=6, minRows=8, maxBins=16, finish=finish).fit(data)
    y = np.array([r[7] for r in rows()])
    base = math.log(y.mean() / (1 - y.mean()))
    want = brute_boost(matrix(m.ensemble.bins), y, m.ensemble.bins, 2, 6, 8, 0.5, base)
    assert np.allclose(scores(m, data), want)
    assert all((t.feature < 0).sum() <= 6 for t in m.ensemble.trees)


def test_log_loss_falls_with_every_stage(data):
    for m in (O.LeafwiseBoostingClassifier(maxIter=6, every=1).fit(data), O.OrderedBoostingClassifier(maxIter=6, every=1, catCols=["cat"], keyCol="id").fit(data)):
        assert len(m.losses) == 6 and all(b < a for a, b in zip(m.losses, m.losses[1:]))


def test_margins_written_in_between_change_nothing(data):
    a, b = (O.LeafwiseBoostingClassifier(maxIter=5, every=k).fit(data) for k in (2, 100))
    assert np.allclose(scores(a, data), scores(b, data))


def test_symmetric_trees_have_one_split_a_level_on_both_routes(data):
    a, b = (O.OrderedBoostingClassifier(maxIter=3, maxDepth=3, catCols=["cat"], keyCol="id", finish=f).fit(data) for f in (0, T.FINISH))
    assert np.allclose(scores(a, data), scores(b, data))
    for t in a.trees.ensemble.trees:
        level = [0]
        while level:
            assert len({(t.feature[n], t.bin[n]) for n in level}) == 1
            level = [c for n in level if t.feature[n] >= 0 for c in (t.left[n], t.left[n] + 1)]


def test_ordered_statistics_count_only_rows_before(spark):
    r = random.Random(8)
    some = [(i, r.choice("aaaaab"), float(r.random() < 0.4)) for i in range(300)]

    def stats(rows):
        df = spark.createDataFrame(rows, "id long, cat string, y double").withColumn("o", F.xxhash64("id")).repartition(4)
        return {r.id: r for r in O.ordered_statistics(df, ["cat"], "y", "o", 0.3, buckets=8).collect()}
    got = stats(some)
    place = {i: r.o & (2**64 - 1) for i, r in got.items()}
    for i, cat, _ in some:
        before = [y for j, c, y in some if c == cat and place[j] < place[i]]
        assert got[i].cat_ts == pytest.approx((sum(before) + 0.3) / (len(before) + 1))
    # a row's own label never reaches its own statistic
    flipped = [(i, c, 1 - y if i == 7 else y) for i, c, y in some]
    again = stats(flipped)
    assert again[7].cat_ts == got[7].cat_ts and any(again[i].cat_ts != got[i].cat_ts for i in got)


def test_raw_categories_and_unknown_ones(spark, data):
    m = O.OrderedBoostingClassifier(maxIter=10, catCols=["cat"], keyCol="id").fit(data)
    new = data.withColumn("cat", F.when(F.col("id") % 2 == 0, F.lit("never seen")))
    out = m.transform(new)
    assert out.count() == len(rows()) and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0 and out.columns[:len(data.columns)] == data.columns


def test_adaboost_equals_brute_force(data):
    m = O.AdaBoostClassifier(maxIter=5, maxBins=16).fit(data)
    x, y = matrix(m.ensemble.bins), np.array([r[7] for r in rows()])
    w, total, votes = np.ones(len(y)), 0.0, np.zeros(len(y))
    for _ in range(5):
        best = None
        for f in range(x.shape[1]):
            for cut in range(len(m.ensemble.bins.cuts[f])):
                left = x[:, f] <= cut
                score = sum(((w[i] * (1 - y[i])).sum() ** 2 + (w[i] * y[i]).sum() ** 2) / w[i].sum() for i in (left, ~left) if i.any())
                if left.any() and not left.all() and (best is None or score > best[0] + 1e-9):
                    best = score, left
        guess = np.zeros(len(y), bool)
        for i in (best[1], ~best[1]):
            guess[i] = (w[i] * y[i]).sum() > (w[i] * (1 - y[i])).sum()
        miss = guess != (y > 0.5)
        error = (w * miss).sum() / w.sum()
        alpha = math.log((1 - error) / error)
        w = w * np.exp(alpha * miss)
        votes += alpha * (2 * guess - 1)
        total += alpha
    assert np.allclose(scores(m, data), votes / total)


def own_estimators():
    return {"et": O.ExtraTreesClassifier(numTrees=5), "ada": O.AdaBoostClassifier(maxIter=3), "lda": O.LinearDiscriminant(), "leafwise": O.LeafwiseBoostingClassifier(maxIter=3),
            "ordered": O.OrderedBoostingClassifier(maxIter=3, catCols=["cat"], keyCol="id"), "rbf": O.FourierSVC(components=20, maxIter=10)}


@pytest.mark.parametrize("name", list(own_estimators()))
def test_own_models_persist_in_pipelines(spark, data, name):
    path = scratch_path(spark, f"own-{uuid.uuid4().hex}")
    raw = data.drop("features")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=[f"x{j}" for j in range(P)], outputCol="features"), own_estimators()[name]]).fit(raw)
    fitted.write().save(path)
    again = PipelineModel.load(path)
    assert np.allclose(scores(again, raw), scores(fitted, raw))
    assert [r[0] for r in again.transform(raw).orderBy("id").select("prediction").collect()] == [r[0] for r in fitted.transform(raw).orderBy("id").select("prediction").collect()]


def test_ensembles_persist(spark, data):
    parts = {"et": O.ExtraTreesClassifier(numTrees=3), "lda": O.LinearDiscriminant(), "ada": O.AdaBoostClassifier(maxIter=2)}
    for m in (EN.fit_voting(data, parts), EN.fit_stacking(data, parts, "id", folds=2)):
        path = scratch_path(spark, f"own-{uuid.uuid4().hex}")
        PipelineModel(stages=[m]).write().save(path)
        again = PipelineModel.load(path)
        assert scores(again, data, "prediction") == scores(m, data, "prediction")


def test_own_estimators_enter_a_search(data):
    cv = TU.randomized_search(O.ExtraTreesClassifier(numTrees=2), {"numTrees": [2, 4], "maxDepth": [1, 0]}, data, "id", n_iter=3, folds=2)
    assert len(cv.avgMetrics) == 3 and isinstance(cv.bestModel, O.TreeModel)
    grid = TU.grid_search(O.ForestRegressor(numTrees=2), {"maxDepth": [1, 6]}, data.select("id", "features", F.col("target").alias("label")), "id", regression=True)
    assert grid.avgMetrics[1] > grid.avgMetrics[0]


def test_a_winner_that_cannot_be_saved_is_an_error(spark, data):
    class Unsavable:
        def transform(self, df):
            return df.withColumn("prediction", F.col("label")).withColumn("score", F.col("label"))
    from netquery.models.base import Prepared
    prep = Prepared(data, data, PipelineModel(stages=[]), P)
    with pytest.raises(TypeError, match="cannot be saved"):
        run_detection(prep, {"X": Candidate(lambda df: Unsavable(), "keep")}, tune_top=0, out_dir=scratch_path(spark, f"own-{uuid.uuid4().hex}"), key="id")


def test_bins_hold_extremes_and_nan():
    b = T.Bins([np.array([0.0]), np.array([1.0, 5.0])])
    assert b.of(np.array([[0.0, 1.0], [1.0, 6.0], [np.nan, np.nan]])).tolist() == [[0, 0], [1, 2], [1, 2]]


def test_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(i, 1.0, 3.0) for i in range(30)], "id long, label double, x double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    for e in (O.ExtraTreesClassifier(numTrees=2), O.LeafwiseBoostingClassifier(maxIter=2), O.ForestRegressor(numTrees=2), O.OrderedBoostingClassifier(maxIter=2), O.AdaBoostClassifier(maxIter=2)):
        assert e.fit(df).transform(df).where("prediction IS NULL").count() == 0


def test_finished_subtrees_stay_arrays_and_make_the_same_tree(spark):
    """A full tree has as many nodes as rows: the driver holds those below the finished nodes as arrays, and where the
    nodes were finished does not show in the tree."""
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(3)
    rows = [(Vectors.dense(v.tolist()), float(y)) for v, y in zip(rng.normal(size=(600, 4)), rng.normal(size=600))]
    df = spark.createDataFrame(rows, ["features", "label"])
    bins = T.fit_bins(df, 64)
    table = T.binned(df, bins, F.col("label").alias("y"))

    def sums(b, t):
        y = b.column(b.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
        return np.stack([np.ones(len(y)), np.ones(len(y)), y], 1)
    part, rule = T.Rows(table, bins, sums), T.Rule("variance")
    root = T.root_sums(part, [0])
    size = len(bins.cuts) + 24
    whole, parts = (T.grow_forest(part, rule, [0], root, finish=n * size)[0] for n in (600, 100))
    assert len(whole.feature) == 1 and len(whole.subs) == 1 and len(parts.subs) > 3 and len(parts.feature) < 100
    x = rng.integers(0, 64, size=(500, 4)).astype(np.uint8)
    a, b = whole.tree(rule), parts.tree(rule)
    assert len(a.feature) == len(b.feature) > 600 and sorted(a.value) == pytest.approx(sorted(b.value))
    assert a.value[a.leaves(x)] == pytest.approx(b.value[b.leaves(x)])


# ---- forests of best cuts ----------------------------------------------------

@pytest.mark.parametrize("rule", [T.Rule("gini"), T.Rule("variance", least_rows=2), T.Rule("gini", tries=2, best=True)])
def test_small_nodes_are_cut_by_their_rows_as_by_histograms(monkeypatch, rule):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (400, 5)).astype(np.uint8)
    y = (rng.random(400) < 0.3 + 0.05 * x[:, 0]).astype(float) if rule.score == "gini" else x[:, 1] + rng.normal(size=400)
    n = rng.integers(1, 4, 400).astype(float)
    sums = np.stack([np.ones(400), n * (1 - y), n * y], 1) if rule.score == "gini" else np.stack([np.ones(400), n, n * y], 1)
    bins = T.Bins([np.arange(11.0)] * 5)
    cells = []
    count = T._histograms
    monkeypatch.setattr(T, "_histograms", lambda x, s, node, nodes, width: cells.append(nodes * width) or count(x, s, node, nodes, width))
    a = T.grow_levels(rule, bins, 0, 0, 0, x, sums).tree(rule)
    assert sum(cells) < 12 * len(a.feature)              # a level of small nodes costs as its rows
    monkeypatch.setattr(T, "SMALL", (1,))
    b = T.grow_levels(rule, bins, 0, 0, 0, x, sums).tree(rule)
    for k in ("feature", "bin", "left"):
        np.testing.assert_array_equal(getattr(a, k), getattr(b, k))
    np.testing.assert_allclose(a.value, b.value, atol=1e-9)


def test_forest_is_the_same_on_both_routes_and_splits_what_it_can(data):
    from netquery.models import classifiers as CL
    made = [O.ForestClassifier(numTrees=4, maxBins=16, seed=3, finish=f, gathered=g).fit(data) for f, g in ((1 << 23, 1 << 30), (2000, 1))]
    assert np.allclose(scores(made[0], data), scores(made[1], data))
    shares = made[0].featureImportances.toArray()
    assert len(shares) == len(data.first()["features"]) and abs(shares.sum() - 1) < 1e-9 and (shares >= 0).all()
    m = CL.random_forest(20, weighted=False).fit(data)
    assert isinstance(m, O.ForestClassifierModel)
    out = m.transform(data).select("label", "prediction", "score", "probability").toPandas()
    assert out["score"].between(0, 1).all() and (out["label"] == out["prediction"]).mean() > 0.9
    np.testing.assert_allclose([p[1] for p in out["probability"]], out["score"])
    whole = O.ForestClassifier(numTrees=1, maxBins=255, bootstrap=False, featureSubsetStrategy="all").fit(data).transform(data)
    assert whole.where("label <> prediction").count() <= 0.01 * data.count()


def test_rows_of_one_task_take_a_job_for_many_stages(data, monkeypatch):
    passes = []
    finish = T._finish_pass
    monkeypatch.setattr(T, "_finish_pass", lambda *a: passes.append(1) or finish(*a))
    for make in (lambda **kw: O.LeafwiseBoostingClassifier(maxIter=5, every=2, minRows=5, numLeaves=6, **kw), lambda **kw: O.OrderedBoostingClassifier(maxIter=5, every=2, maxDepth=3, keyCol="id", **kw)):
        one, many = make().fit(data), make(finish=0).fit(data)
        assert len(one.losses) == 3 and np.allclose(one.losses, many.losses)
        assert np.allclose(scores(one, data), scores(many, data))
    assert not passes


def test_saved_forest_keeps_scores_and_importances(spark, data):
    m = O.ForestClassifier(numTrees=3, maxDepth=4).fit(data)
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    PipelineModel(stages=[m]).write().overwrite().save(path)
    back = PipelineModel.load(path).stages[0]
    assert np.allclose(scores(m, data), scores(back, data))
    assert np.allclose(m.featureImportances.toArray(), back.featureImportances.toArray())
