"""Model invariants on learnable data: scores in [0, 1], better than the
majority class, reproducible, and persisted pipelines score identically."""

import uuid

import numpy as np
import pytest
from pyspark.ml import classification as C
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import SF0001
from netquery.models import base as B
from netquery.models import classifiers as CL
from netquery.models import custom as CU
from netquery.models import ensembles as EN
from netquery.models import linear as LI
from netquery.models import own as O
from netquery.models import tuning as TU
from netquery.plans.derived import connection_records
from netquery.session import scratch_path


@pytest.fixture(scope="module")
def prep(spark):
    p = B.prepare(connection_records(spark, SF0001), balanced=True)
    yield p
    p.release()


def _acc(pred):
    return pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def _majority(p):
    share = p.test.agg(F.avg("label")).first()[0]
    return max(share, 1 - share)


def test_prepared_vectors(prep):
    assert prep.n_features > 20
    assert prep.train.where("weight <= 0").count() == 0


@pytest.mark.parametrize("name", ["lr", "tree", "forest", "gbt", "nb"])
def test_builtin_models_learn(prep, name):
    n = B.n_weight(prep.train)
    est = {"lr": CL.logistic_regression(n, max_iter=30), "tree": CL.decision_tree(),
           "forest": CL.random_forest(10, max_depth=8), "gbt": CL.gradient_boosting(10), "nb": CL.gaussian_nb()}[name]
    pred = B.with_score(est.fit(prep.train).transform(prep.test), "probability")
    s = pred.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= s[0] <= s[1] <= 1.0
    if name != "nb":
        assert _acc(pred) > _majority(prep)


def test_custom_models(prep):
    for m in (CU.fit_adaboost(prep.train, n_estimators=4), CU.fit_lda(prep.train),
              CU.fit_extra_trees(prep.train, num_trees=6, groups=2, max_depth=8),
              CU.fit_rbf_svc(prep.train, n_components=50, max_iter=20)):
        pred = m.transform(prep.test)
        assert pred.count() == prep.test.count()
        assert _acc(pred) > 0.5
    et = CU.fit_extra_trees(prep.train, num_trees=6, groups=2, max_depth=8).transform(prep.test)
    assert _acc(et) > _majority(prep)


def _points(spark, n=400):
    r = np.random.default_rng(5)
    x = r.normal(size=(n, 4)) * [1, 10, 0.1, 0] + [0, 50, 0, 3]        # the last feature is constant
    y = (x[:, 0] + 0.1 * x[:, 1] - 5 + r.normal(size=n) * 0.7 > 0).astype(float)
    rows = [(i, v.tolist(), float(t), 1.0 + i % 3) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, x array<double>, label double, weight double").select("id", array_to_vector("x").alias("features"), "label", "weight").repartition(3).cache()


def test_settings_fitted_together_are_those_of_spark(spark, monkeypatch):
    d, sizes = _points(spark), []
    at = LI.Passes.at
    monkeypatch.setattr(LI.Passes, "at", lambda self, points: sizes.append(len(points)) or at(self, points))
    est = O.LogisticTogether(weightCol="weight", tol=1e-12)
    settings = [1e-3, 1e-2, 0.3]
    got = dict(est.fitMultiple(d, [{est.regParam: v} for v in settings]))
    assert sizes[0] == 3 and len(sizes) < 60         # one pass for all settings
    for i, v in enumerate(settings):
        want = C.LogisticRegression(regParam=v, standardization=False, weightCol="weight", tol=1e-12).fit(d)
        assert np.allclose(got[i].w, want.coefficients.toArray(), rtol=1e-4, atol=1e-6) and abs(got[i].b - want.intercept) < 1e-3
        a, b = (m.transform(d).select("id", "prediction") for m in (got[i], want))
        assert a.exceptAll(b).count() == 0
    cv = TU.randomized_search(est, {"regParam": settings}, d, "id", n_iter=3, folds=2)
    assert max(cv.avgMetrics) > 0.8 and _acc(cv.bestModel.transform(d)) > 0.85


def test_linear_fits_reject_what_is_not_a_number(spark):
    d = spark.createDataFrame([(0, [1.0, float("nan")], 0.0), (1, [2.0, 1.0], 1.0)], "id long, x array<double>, label double").select("id", array_to_vector("x").alias("features"), "label")
    for est in (O.LogisticTogether(), O.FourierSVC(components=3)):
        with pytest.raises(ValueError, match="NaN"):
            est.fit(d)


def test_fourier_features_are_not_kept(spark):
    d = _points(spark)
    d.count()
    before, kept = set(spark.sparkContext._jsc.getPersistentRDDs().keySet()), []
    at = LI.Passes.at

    def seen(self, points):
        kept.extend(set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) - before)
        return at(self, points)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(LI.Passes, "at", seen)
        got = CU.fit_rbf_svc(d, n_components=30, max_iter=100)
    assert not kept
    # the loss is that of Spark's linear SVM on the same features, or less
    x = np.array([r.features.toArray() for r in d.orderBy("id").select("features").collect()])
    y = np.array([r.label for r in d.orderBy("id").collect()])
    z = CU.rff(got.W, got.b)(x)
    zs = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(z, y, strict=True)], "z array<double>, label double").select(array_to_vector("z").alias("features"), "label")
    svc = C.LinearSVC(maxIter=100, regParam=1.0 / len(y), standardization=False).fit(zs)

    def loss(w, c):
        return LI.hinge_loss(z @ w + c, y)[0].mean() + 0.5 / len(y) * (w @ w)
    assert loss(got.w, got.c) <= loss(svc.coefficients.toArray(), svc.intercept) * 1.02
    assert np.allclose([r.score for r in got.transform(d).orderBy("id").collect()], z @ got.w + got.c)


def test_reproducible_and_persisted(spark, prep):
    a = CL.random_forest(5, max_depth=6).fit(prep.train).transform(prep.test).select("conn_id", "prediction")
    b = CL.random_forest(5, max_depth=6).fit(prep.train).transform(prep.test).select("conn_id", "prediction")
    assert a.exceptAll(b).count() == 0
    tree = CL.decision_tree().fit(prep.train)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    TU.save_model(prep.pre, tree, path)
    raw = connection_records(spark, SF0001).where("split = 'test'")
    re = TU.load_and_score(path, raw).select("conn_id", "prediction")
    direct = tree.transform(prep.test).select("conn_id", "prediction")
    assert re.exceptAll(direct).count() == 0 and re.count() == direct.count()


def test_ensembles_and_evaluate_many(prep):
    n = B.n_weight(prep.train)
    members = {"lr": CL.logistic_regression(n, max_iter=20).fit(prep.train),
               "tree": CL.decision_tree().fit(prep.train), "nb": CL.gaussian_nb().fit(prep.train)}
    v = EN.hard_vote(members, prep.test, "conn_id")
    assert v.count() == prep.test.count()
    board = TU.evaluate_many({"tree": (CL.decision_tree(), "probability"), "lda": (CU.fit_lda, "keep")},
                             prep.train, prep.test).collect()
    assert [r.model for r in board][0] == "tree" and board[0].roc_auc is not None


def test_detection_run_writes_reports_and_winner(spark, prep):
    from pyspark.ml import PipelineModel

    from netquery.models.workflow import Candidate, run_detection
    n = B.n_weight(prep.train)
    cands = {"LogReg": Candidate(CL.logistic_regression(n, max_iter=10), "probability",
                                 {"regParam": [1.0 / n, 10.0 / n]}),
             "DecisionTree": Candidate(CL.decision_tree(max_depth=8), "probability"),
             "Bagging(Tree)": Candidate(CL.bagging_trees(3, max_depth=6), None, phase="ensembles")}
    out = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    final = run_detection(prep, cands, "all", tune_top=3, n_iter=2, folds=2, out_dir=out).collect()
    assert {r.model for r in final} >= {"LogReg", "DecisionTree", "Bagging(Tree)", "LogReg(tuned)"}
    assert [r.f1 for r in final] == sorted((r.f1 for r in final), reverse=True)
    md = [r.value for r in spark.read.text(f"{out}/results_summary_md").collect()]
    assert md[0] == "# Resumen de Resultados (Top-5)" and md[2] == "| Modelo | F1 | Accuracy |" and len(md) == 4 + len(final[:5])
    assert spark.read.option("header", True).csv(f"{out}/results_summary").count() == 3
    best = PipelineModel.load(f"{out}/best_model")
    raw = connection_records(spark, SF0001).where("split = 'test'")
    assert best.transform(raw).count() == raw.count()


def _brute_neighbours(tr, te, k):
    import numpy as np
    x = np.array([t[1] for t in tr])
    out = {}
    for vid, v, _ in te:
        d = np.sqrt(((x - np.array(v)) ** 2).sum(axis=1))
        out[vid] = [tr[i][0] for i in sorted(range(len(tr)), key=lambda i: (d[i], tr[i][0]))[:k]]
    return out


def _neighbours(rows):
    got = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.test_key, []).append(r.train_key)
    return got


def test_knn_exact_across_cells(spark):
    import numpy as np

    from netquery.models.knn import knn_neighbours, knn_predict
    rng = np.random.default_rng(9)
    # spread rows, a third of all rows in one place, and large coordinates
    tr = [(i, rng.normal(size=6).tolist(), int(rng.integers(0, 2))) for i in range(150)] + [(200 + i, [1.0] * 6, 1) for i in range(80)]
    tr += [(400 + i, (1e6 + rng.normal(size=6)).tolist(), 0) for i in range(20)]
    te = [(1000 + j, rng.normal(size=6).tolist(), 0) for j in range(30)] + [(1100, [1.0] * 6, 0), (1101, [1e6] * 6, 0)]
    schema = "vid long, v array<double>, y int"
    TR, TE = spark.createDataFrame(tr, schema), spark.createDataFrame([*te, (1102, None, 0)], schema)
    got = _neighbours(knn_neighbours(TR, TE, "vid", "v", "y", k=5, cell_rows=20, block_rows=13, visit_rows=7).collect())
    assert got == _brute_neighbours(tr, te, 5)
    pred = {r.vid: r.prediction for r in knn_predict(TR, TE, "vid", "v", "y", 5, cell_rows=50).collect()}
    assert len(pred) == len(te)
    few = _neighbours(knn_neighbours(TR.where("vid < 3"), TE, "vid", "v", "y", k=5).collect())
    assert all(sorted(v) == [0, 1, 2] for v in few.values()) and len(few) == len(te)
    assert knn_neighbours(TR.where("false"), TE, "vid", "v", "y").count() == 0


def test_knn_visits_few_cells_of_clustered_rows(spark):
    import math

    import numpy as np

    from netquery.models.knn import Cells, knn_neighbours
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(25, 8)) * 10
    point = lambda i: (centres[i % 25] + rng.normal(size=8) * 0.1).tolist()
    tr, te = [(i, point(i), 0) for i in range(1500)], [(5000 + i, point(i), 0) for i in range(50)]
    schema = "vid long, v array<double>, y int"
    TR, TE = spark.createDataFrame(tr, schema), spark.createDataFrame(te, schema)
    assert _neighbours(knn_neighbours(TR, TE, "vid", "v", "y", k=5, cell_rows=30).collect()) == _brute_neighbours(tr, te, 5)
    cells = Cells(TR, "vid", "v", "y", 30)
    asked = TE.select(F.col("vid").alias("test_key"), "v", F.lit(0.6).alias("bound"))
    met = sum(int(cells.size[r.cell]) for first in (True, False) for r in cells.visits(asked if not first else asked.withColumn("bound", F.lit(math.inf)), 5, first).collect())
    assert met < 0.25 * len(tr) * len(te)


def test_per_model_reports_and_csv_scoring(spark, prep):
    from netquery.models.tuning import save_model, score_csv
    from netquery.models.workflow import Candidate, run_detection
    from netquery.sources.readers import FEATURE_COLUMNS
    from netquery.sources.sinks import write_csv
    out = scratch_path(spark, f"rep-{uuid.uuid4().hex}")
    run_detection(prep, {"Decision Tree(x)": Candidate(CL.decision_tree(max_depth=6), "probability")},
                  tune_top=0, out_dir=out).collect()
    cm = spark.read.option("header", True).csv(f"{out}/confusion_matrices/decision_tree_x_cm").collect()
    assert [r.actual for r in cm] == ["Real_Normal", "Real_Ataque"] and set(cm[0].asDict()) == {"actual", "Pred_Normal", "Pred_Ataque"}
    rep = spark.read.option("header", True).csv(f"{out}/metrics/decision_tree_x_classification_report")
    assert rep.count() == 5
    tree = CL.decision_tree(max_depth=6).fit(prep.train)
    mpath = f"{out}/model"
    save_model(prep.pre, tree, mpath)
    raw = connection_records(spark, SF0001).where("split = 'test'").select(*FEATURE_COLUMNS)
    write_csv(raw, f"{out}/to_score")
    scored = score_csv(spark, mpath, f"{out}/to_score", f"{out}/predictions")
    assert scored.count() == raw.count() and "prediction" in scored.columns


def test_training_partitions_are_a_given_number(spark):
    recs = connection_records(spark, SF0001)
    assert B.prepare(recs, partitions=3).train.rdd.getNumPartitions() == 3


def _counted(spark, recs):
    """The records, and an accumulator of how many rows were made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(v):
        made.add(1)
        return v
    return recs.withColumn("duration", seen.asNondeterministic()("duration")), made


def test_training_partitions_grow_with_the_rows_and_records_are_made_once(spark):
    recs, made = _counted(spark, connection_records(spark, SF0001))
    p = B.prepare(recs, balanced=True, partitions=3, partition_rows=500)
    n, m = p.train.count(), p.test.count()
    assert n > 2000 and p.train.rdd.getNumPartitions() == -(-n // 500) > 3 and p.test.rdd.getNumPartitions() == max(3, -(-m // 500))
    assert made.value == n + m
    p.release()


def test_class_weights_move_no_rows_to_their_label(spark):
    from netquery.operators.stats import with_class_weights
    df = spark.createDataFrame([(i, float(i % 4 == 0)) for i in range(40)] + [(40, None)], "k long, label double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = with_class_weights(df)
        assert "SortMergeJoin" not in w._jdf.queryExecution().toString()
        assert {(r.label, r.weight) for r in w.collect()} == {(0.0, 41 / (3 * 30)), (1.0, 41 / (3 * 10)), (None, None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_regression_variants_share_one_set_of_records(spark, monkeypatch):
    from netquery.plans import models_q as MQ
    recs, made = _counted(spark, connection_records(spark, SF0001))
    monkeypatch.setattr(MQ, "connection_records", lambda spark, sf: recs)
    assert MQ.q_regression_linear(spark, SF0001).count() == 2
    assert made.value == connection_records(spark, SF0001).count()


def test_visits_of_a_batch_come_in_bounded_parts():
    """Where most cells stay open a row visits them all; a task holds the visits of few rows at once, whatever the batch holds."""
    import numpy as np
    import pandas as pd

    from netquery.models import knn as K

    class Sent:
        value = None
    rng = np.random.default_rng(5)
    pivots = rng.normal(size=(50, 8))
    Sent.value = pivots, np.full(50, 10), np.zeros(50), np.full(50, 20.0), np.array([K.distances(p, pivots) for p in pivots])
    pdf = pd.DataFrame({"test_key": np.arange(300), "v": list(rng.normal(size=(300, 8))), "bound": 9.0})
    parts = list(K._visits(Sent, 5, False, 200)([pdf, pdf.iloc[:0]]))
    assert max(map(len, parts)) < 200 + 50
    got = pd.concat(parts, ignore_index=True)
    assert len(got) == 300 * 49 and (got["turn"] == np.arange(len(got))).all() and (got.groupby("test_key")["cell"].nunique() == 49).all()
    assert all((a == b).all() for a, b in zip(got["v"][::97], pdf["v"].iloc[got["test_key"][::97]]))


class _Seen(Exception):
    pass


def _sizes(cands):
    """Trees, stages and steps of the candidates that have them."""
    out = {}
    for name, c in cands.items():
        e = getattr(c, "make", c[0] if isinstance(c, tuple) else c)
        for p in ("numTrees", "maxIter"):
            if hasattr(e, p):
                out[name] = e.getOrDefault(p)
    return out


_WHOLE = {"LogReg": 1000, "LinearSVC": 100, "RandomForest": 200, "ExtraTrees": 300, "GradBoost": 100, "AdaBoost": 50, "LightGBM": 300, "CatBoost": 300}


def _stopped(prep, monkeypatch, where, name):
    """The arguments with which a query calls `where.name`; it ends there."""
    from netquery.plans import models_q as MQ
    got = {}

    def seen(*a, **kw):
        got.update(a=a, kw=kw)
        raise _Seen
    monkeypatch.setattr(MQ, "prepared", lambda spark, sf: prep)
    monkeypatch.setattr(where, name, seen)
    return MQ, got


def test_detection_run_fits_and_tunes_the_whole_reference_models(spark, prep, monkeypatch):
    from netquery.models import workflow
    MQ, got = _stopped(prep, monkeypatch, workflow, "run_detection")
    with pytest.raises(_Seen):
        MQ.q_detection_run(spark, SF0001)
    cands = got["a"][1]
    assert {k: v for k, v in _sizes(cands).items() if k in _WHOLE} == _WHOLE and _sizes(cands)["Bagging(Tree)"] == 100
    assert cands["RandomForest"].grid["numTrees"] == [100, 200, 300] and cands["ExtraTrees"].grid["numTrees"] == [200, 300, 500]
    assert (got["kw"]["tune_top"], got["kw"]["n_iter"], got["kw"]["folds"]) == (3, 8, 3)
    folds = {}
    monkeypatch.setattr(EN, "fit_stacking", lambda df, members, key, **kw: folds.update(kw, **_sizes(members)))
    cands["Stacking"].make(prep.train)
    assert folds == {"folds": 5, "rf": 150, "gb": 100}


def test_evaluate_many_fits_the_whole_reference_models(spark, prep, monkeypatch):
    MQ, got = _stopped(prep, monkeypatch, TU, "evaluate_many")
    with pytest.raises(_Seen):
        MQ.q_evaluate_many(spark, SF0001)
    assert _sizes(got["a"][0]) == _WHOLE


def test_forests_are_searched_with_the_reference_grids(spark, prep, monkeypatch):
    MQ, got = _stopped(prep, monkeypatch, TU, "randomized_search")
    with pytest.raises(_Seen):
        MQ.q_tune_randomized_forests(spark, SF0001)
    assert got["a"][1]["numTrees"] == [100, 200, 300] and len(got["a"][1]) == 3
    assert (got["kw"]["n_iter"], got["kw"]["folds"]) == (8, 3)
