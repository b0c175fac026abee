"""Boosting on blocks: one task, many tasks and passes over rows make the same trees; gradient boosting against brute force."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from netquery.models import boosting as BO
from netquery.models import classifiers as CL
from netquery.models import own as O
from netquery.models import trees as T


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 9, 700), rng.integers(0, 2, 700), rng.integers(0, 30, 700), rng.integers(0, 3, 700)], 1).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 0) | (x[:, 2] < 5)).astype(float)
    y[rng.random(700) < 0.05] = 1.0
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, label double")
    df = df.select("id", "label", array_to_vector(F.array("a", "b", "c", "d")).alias("features")).repartition(5, "id").cache()
    yield df, x, y
    df.unpersist()


def _scores(m, df):
    return np.array([r.score for r in m.transform(df).orderBy("id").select("score").collect()])


def _brute(x, y, stages, step, depth):
    """Residual trees by plain loops over all cuts, with Newton leaves."""
    base = np.log(y.mean() / (1 - y.mean()))
    m = np.full(len(y), base)

    def grow(rows, r, h, d):
        best, total = (1e-12, None, None), r[rows].sum() ** 2 / len(rows)
        for f in range(x.shape[1] if d < depth else 0):
            for v in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= v]
                right = rows[x[rows, f] > v]
                gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - total
                if gain > best[0] + 1e-9:
                    best = gain, f, v
        if best[1] is None:
            return {rows.tobytes(): (rows, r[rows].sum() / h[rows].sum())}
        return {**grow(rows[x[rows, best[1]] <= best[2]], r, h, d + 1), **grow(rows[x[rows, best[1]] > best[2]], r, h, d + 1)}
    for _ in range(stages):
        q = 1 / (1 + np.exp(-m))
        for rows, v in grow(np.arange(len(y)), y - q, q * (1 - q), 0).values():
            m[rows] += step * v
    return 1 / (1 + np.exp(-m))


@pytest.mark.parametrize("finish", [1, T.FINISH])
def test_gradient_boosting_equals_brute_force(data, finish):
    df, x, y = data
    m = O.GradientBoostingClassifier(maxIter=4, stepSize=0.3, finish=finish, every=3).fit(df)
    assert np.allclose(_scores(m, df), _brute(x, y, 4, 0.3, 3))
    assert len(m.losses) == 2 and m.losses[1] < m.losses[0]
    p = m.transform(df).select("probability", "score").first()
    assert abs(p.probability[1] - p.score) < 1e-12


def test_many_tasks_grow_the_trees_of_one(data, monkeypatch):
    df, _, _ = data
    monkeypatch.setattr(BO, "BLOCK", 40)
    monkeypatch.setattr(BO, "PART", 100)
    monkeypatch.setattr(BO, "FEW", 3)
    for make in (lambda **kw: O.LeafwiseBoostingClassifier(maxIter=4, every=2, minRows=5, numLeaves=6, **kw), lambda **kw: O.OrderedBoostingClassifier(maxIter=4, every=2, maxDepth=3, keyCol="id", **kw)):
        one, many, passes = (make(finish=f).fit(df) for f in (T.FINISH, 1, 0))
        assert np.allclose(_scores(one, df), _scores(many, df)) and np.allclose(_scores(one, df), _scores(passes, df))
        assert np.allclose(one.losses, many.losses)


def test_features_counted_together_have_their_own_histograms(monkeypatch):
    rng = np.random.default_rng(0)
    widths = [60, 2, 50, 2, 7, 2, 65]
    x = np.stack([rng.integers(0, w, 500) for w in widths]).astype(np.uint8)
    y, w = rng.integers(0, 2, 500).astype(float), rng.random(500)
    bins = T.Bins([np.arange(k - 1.0) for k in widths])
    c = BO.Counter(bins, O._newton_slopes)
    assert len(c.groups) < len(widths) and all(np.prod([widths[f] for f in g]) <= BO.CELLS for g in c.groups)
    tree = T.Tree(np.array([2, -1, -1]), np.array([20, 0, 0]), np.array([1, -1, -1]), np.zeros(3))
    got = c.counted([(x.tobytes(), y.tobytes(), w.tobytes(), np.zeros(500).tobytes())], tree, [2, 1])
    sums = np.stack([np.ones(500), *O._newton_slopes(y, w, np.zeros(500))], 1)
    want = T._histograms(np.ascontiguousarray(x.T), sums, (x[2] <= 20).astype(np.int64), 2, bins.width)
    assert np.allclose(got, want)


def test_gradient_boosting_is_not_spark_jobs_for_each_level(data):
    """A stage that one task can make starts no job of its own."""
    df, _, _ = data
    assert isinstance(CL.gradient_boosting(3), O.GradientBoostingClassifier)
    t = df.sparkSession.sparkContext.statusTracker()
    group = "boosting-jobs"
    df.sparkSession.sparkContext.setJobGroup(group, "")
    try:
        CL.gradient_boosting(3).fit(df)
        few = len(t.getJobIdsForGroup(group))
        df.sparkSession.sparkContext.setJobGroup(group + "2", "")
        CL.gradient_boosting(40).fit(df)
        assert len(t.getJobIdsForGroup(group + "2")) == few
    finally:
        df.sparkSession.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("bad", [(float("nan"), 1.0), (float("inf"), 1.0), (1.0, 2.0), (1.0, None)])
def test_gradient_boosting_rejects_what_is_not_a_number(spark, bad):
    rows = [(float(i), float(i % 2)) for i in range(20)] + [bad]
    df = spark.createDataFrame(rows, "a double, label double").select("label", array_to_vector(F.array("a")).alias("features"))
    with pytest.raises(ValueError):
        O.GradientBoostingClassifier(maxIter=1).fit(df)
