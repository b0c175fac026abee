"""Metric operators against the recovered goldens and brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from netquery.operators import metrics as M
from netquery.operators.ordered import running_sum

# Recovered confusion counts (tp, fp, fn, tn) and the published metrics
# (accuracy, precision, recall, f1) they reproduce.
GOLDEN = {
    "GradBoost": ((8742, 254, 4091, 9457), (0.8073, 0.9718, 0.6812, 0.8010)),
    "Bagging(Tree)": ((8592, 282, 4241, 9429), (0.7994, 0.9682, 0.6695, 0.7916)),
    "Stacking": ((8394, 271, 4439, 9440), (0.7911, 0.9687, 0.6541, 0.7809)),
    "ExtraTrees": ((8378, 278, 4455, 9433), (0.7901, 0.9679, 0.6528, 0.7797)),
    "DecisionTree": ((8297, 303, 4536, 9408), (0.7854, 0.9648, 0.6465, 0.7742)),
    "SVC_RBF": ((8313, 340, 4520, 9371), (0.7844, 0.9607, 0.6478, 0.7738)),
    "Voting(hard)": ((7978, 265, 4855, 9446), (0.7729, 0.9679, 0.6217, 0.7571)),
    "LDA": ((8119, 659, 4714, 9052), (0.7617, 0.9249, 0.6327, 0.7514)),
    "RandomForest": ((7870, 263, 4963, 9448), (0.7682, 0.9677, 0.6133, 0.7507)),
    "AdaBoost": ((7818, 294, 5015, 9417), (0.7645, 0.9638, 0.6092, 0.7465)),
    "KNN": ((7776, 264, 5057, 9447), (0.7640, 0.9672, 0.6059, 0.7451)),
    "LinearSVC": ((7958, 726, 4875, 8985), (0.7516, 0.9164, 0.6201, 0.7397)),
    "LogReg": ((7566, 712, 5267, 8999), (0.7348, 0.9140, 0.5896, 0.7168)),
    "GaussianNB": ((3128, 70, 9705, 9641), (0.5664, 0.9781, 0.2437, 0.3902)),
}


def _expand(spark, counts_by_model):
    rows = []
    for model, (tp, fp, fn, tn) in counts_by_model.items():
        rows += [(model, 1, 1, tp), (model, 0, 1, fp), (model, 1, 0, fn), (model, 0, 0, tn)]
    df = spark.createDataFrame(rows, "model string, label int, prediction int, n int")
    return df.select("model", "label", "prediction", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_"))


def test_binary_metrics_reproduce_published_table(spark):
    df = _expand(spark, {m: c for m, (c, _) in GOLDEN.items()})
    got = {r["model"]: r for r in M.binary_metrics(df, by=["model"]).collect()}
    for model, ((tp, fp, fn, tn), pub) in GOLDEN.items():
        r = got[model]
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, tn)
        assert r.tp + r.fp + r.fn + r.tn == 22544
        for value, expected in zip((r.accuracy, r.precision, r.recall, r.f1), pub):
            assert round(value, 4) == pytest.approx(expected, abs=1e-9), model


def test_leaderboard_order_matches_published(spark):
    df = _expand(spark, {m: c for m, (c, _) in GOLDEN.items()})
    board = M.leaderboard(M.binary_metrics(df, by=["model"]).select("model", "accuracy", "f1"))
    assert [r.model for r in board.collect()] == list(GOLDEN)
    assert [r.model for r in M.topk(board, 3).collect()] == list(GOLDEN)[:3]


def test_confusion_matrix_layout_and_one_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 0)], "label int, prediction int")
    cm = {r.actual: (r.Pred_Normal, r.Pred_Ataque) for r in M.confusion_matrix(df).collect()}
    assert cm == {"Real_Normal": (2, 1), "Real_Ataque": (0, 0)}
    m = M.binary_metrics(df).first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)      # zero_division = 0
    s = df.withColumn("score", F.col("prediction").cast("double"))
    assert M.roc_auc(s).first().roc_auc is None                   # one class only


def test_classification_report(spark):
    df = _expand(spark, {"x": (8742, 254, 4091, 9457)}).select("label", "prediction")
    rep = {r["class"]: r for r in M.classification_report(df).collect()}
    assert rep["Ataque"].support == 12833 and rep["Normal"].support == 9711
    assert round(rep["Ataque"].f1_score, 4) == 0.8010
    assert round(rep["accuracy"].f1_score, 4) == 0.8073
    macro = (rep["Normal"].f1_score + rep["Ataque"].f1_score) / 2
    assert rep["macro avg"].f1_score == pytest.approx(macro)


def _brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def _brute_ap(labels, scores):
    P = sum(labels)
    ap = 0.0
    for t in sorted(set(scores), reverse=True):
        sel = [y for y, s in zip(labels, scores) if s >= t]
        at = [y for y, s in zip(labels, scores) if s == t]
        ap += sum(at) / P * (sum(sel) / len(sel))
    return ap


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_auc_and_ap_against_brute_force(spark, buckets):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 30))) for _ in range(400)]   # many ties
    df = spark.createDataFrame(rows, "label int, score double").repartition(5)
    labels, scores = zip(*rows)
    spark.conf.set("spark.sql.shuffle.partitions", str(max(2, buckets)))
    try:
        auc = M.roc_auc(df).first().roc_auc
        ap = M.average_precision(df).first().average_precision
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert auc == pytest.approx(_brute_auc(labels, scores))
    assert ap == pytest.approx(_brute_ap(labels, scores))


def test_roc_and_pr_curves(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    roc = {r.threshold: (r.fpr, r.tpr) for r in M.roc_curve(df).collect()}
    assert roc[float("inf")] == (0.0, 0.0)
    assert roc[0.9] == (0.0, 0.5) and roc[0.8] == (0.5, 1.0) and roc[0.1] == (1.0, 1.0)
    pr = {r.threshold: (r.precision, r.recall) for r in M.pr_curve(df).collect()}
    assert pr[0.8] == (pytest.approx(2 / 3), 1.0) and pr[float("inf")] == (1.0, 0.0)


@pytest.mark.parametrize("n_buckets", [2, 5, 50])
def test_running_sum_matches_cumsum(spark, n_buckets):
    rnd = np.random.default_rng(3)
    keys = rnd.integers(0, 40, 300)
    vals = rnd.integers(0, 9, 300)
    df = spark.createDataFrame([(int(k), int(v), int(k % 3)) for k, v in zip(keys, vals)], "k long, v long, g long")
    g = df.groupBy("g", "k").agg(F.sum("v").alias("v"))
    out = running_sum(g, "k", ["v"], by=["g"], n_buckets=n_buckets).collect()
    for r in out:
        exp = int(sum(v for k, v, gg in zip(keys, vals, keys % 3) if gg == r.g and k <= r.k))
        assert r.v_cum == exp
    desc = running_sum(g.where("g = 0"), "k", ["v"], descending=True, inclusive=False, n_buckets=n_buckets).collect()
    for r in desc:
        exp = int(sum(v for k, v in zip(keys, vals) if k % 3 == 0 and k > r.k))
        assert r.v_cum == exp


def test_regression_metrics(spark):
    y = np.array([1.0, 2.0, 4.0, 8.0])
    p = np.array([1.5, 2.0, 3.0, 9.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    r = M.regression_metrics(df).first()
    assert r.mse == pytest.approx(np.mean((y - p) ** 2))
    assert r.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_argmax_first_keeps_earliest(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("b", 0.9, 0), ("c", 0.5, 2)], "model string, acc double, pos int")
    assert M.argmax_first(df, "acc", "pos").first().model == "b"
