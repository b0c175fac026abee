"""Connection-record CSV sources, labels, encoding, alignment, scaling, EDA, sampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from netquery.functions.scalar import attack_label, importance
from netquery.operators import features as FE
from netquery.operators import sampling as SM
from netquery.operators import stats as ST
from netquery.sources import readers as R


def _row(duration, proto, service, flag, src, dst, rate, attack, diff=1):
    vals = [duration, proto, service, flag, src, dst] + [0] * 18 + [rate] * 7 + [5, 5] + [rate] * 8 + [attack, diff]
    return ",".join("" if v is None else str(v) for v in vals)


@pytest.fixture(scope="module")
def csvs(tmp_path_factory):
    d = tmp_path_factory.mktemp("conn")
    train = [_row(0, "tcp", "http", "SF", 181, 5450, 0.0, "normal"),
             _row(2, "udp", "private", "S0", 0, 0, 1.0, "neptune"),     # zero bytes both ways
             _row(1, "icmp", "ecr_i", "SF", 1032, 0, 0.5, None),         # null attack
             _row(3, "tcp", "telnet_only_train", "REJ", 10, 20, 0.25, "normal")]
    test = [_row(0, "tcp", "http", "SF", 100, 200, 0.0, "neptune"),
            _row(5, "tcp", "x11_only_test", "SF", 50, 50, 0.0, "smurf")]   # one-class test set
    (d / "train.csv").write_text("\n".join(train) + "\n")
    (d / "test.csv").write_text("\n".join(test) + "\n")
    return str(d / "train.csv"), str(d / "test.csv")


def test_read_and_label(spark, csvs):
    tr = R.read_connections(spark, csvs[0])
    assert len(tr.columns) == 43 and dict(tr.dtypes)["serror_rate"] == "double" and dict(tr.dtypes)["src_bytes"] == "bigint"
    lab = {r.src_bytes: r.label for r in tr.withColumn("label", attack_label("attack")).collect()}
    assert lab == {181: 0, 0: 1, 1032: 1, 10: 0}                 # missing attack counts as attack
    imp = tr.withColumn("importance_score", importance()).where("src_bytes = 0").first().importance_score
    assert imp == 0.0


def test_one_hot_alignment(spark, csvs):
    tr, te = R.read_connections(spark, csvs[0]), R.read_connections(spark, csvs[1])
    cats = FE.categories(tr, R.CATEGORICAL_COLUMNS)
    assert cats["flag"] == ["REJ", "S0", "SF"]
    a = FE.one_hot(tr, R.CATEGORICAL_COLUMNS, cats)
    b_own = FE.one_hot(te, R.CATEGORICAL_COLUMNS, FE.categories(te, R.CATEGORICAL_COLUMNS))
    aligned = FE.align_to(b_own, a.columns)
    assert aligned.columns == a.columns
    r = aligned.where("src_bytes = 50").first()
    assert r["service_telnet_only_train"] == 0 and "service_x11_only_test" not in aligned.columns
    direct = FE.one_hot(te, R.CATEGORICAL_COLUMNS, cats).where("src_bytes = 50").first()
    assert sum(direct[c] for c in a.columns if c.startswith("service_")) == 0      # unseen -> all zeros
    x, y = FE.align_common(a, b_own)
    assert x.columns == y.columns and "service_x11_only_test" not in x.columns
    nums = FE.numeric_columns(a, ("protocol_type_", "service_", "flag_"))
    assert "src_bytes" in nums and not any(c.startswith("flag_") for c in nums)


def test_scaling_population_std(spark, csvs):
    tr = R.read_connections(spark, csvs[0])
    params = FE.scale_fit(tr, ["src_bytes", "land"])
    src = np.array([181, 0, 1032, 10], dtype=float)
    assert params["src_bytes"][1] == pytest.approx(src.std())        # population std
    assert params["land"] == (0.0, 1.0)                              # zero variance keeps scale 1
    out = FE.scale_apply(tr.select("src_bytes", "land"), params).collect()
    assert sorted(r.src_bytes for r in out) == pytest.approx(sorted(src / src.std()))
    cen = FE.scale_fit(tr, ["src_bytes"], with_mean=True)
    assert cen["src_bytes"][0] == pytest.approx(src.mean())


def test_exact_quantiles_and_box(spark):
    rng = np.random.default_rng(1)
    hot = rng.normal(0, 1, 3000)         # one group holds most rows
    cold = rng.normal(5, 2, 200)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold] + [("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    q = {r.g: r for r in ST.exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g, vals in (("hot", hot), ("cold", cold), ("one", np.array([7.0]))):
        assert [q[g].q0, q[g].q1, q[g].q2] == pytest.approx(np.percentile(vals, [25, 50, 75]))
    b = {r.g: r for r in ST.box_stats(df, "g", "x").collect()}
    q1, q3 = np.percentile(hot, [25, 75])
    inside = hot[(hot >= q1 - 1.5 * (q3 - q1)) & (hot <= q3 + 1.5 * (q3 - q1))]
    assert b["hot"].lower_whisker == pytest.approx(inside.min()) and b["hot"].outliers == len(hot) - len(inside)


def test_histogram_and_counts(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "x double")
    h = {r.bin: r["count"] for r in ST.histogram(df, "x", 50).collect()}
    assert len(h) == 50 and sum(h.values()) == 101 and h[50] == 3        # the maximum falls in bin 50
    ev = spark.createDataFrame([("a",), ("b",), ("a",)], "t string")
    assert [(r.t, r["count"]) for r in ST.value_counts(ev, "t").collect()] == [("a", 2), ("b", 1)]
    w = {r.label: r.weight for r in ST.class_weights(spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")).collect()}
    assert w[0] == pytest.approx(4 / 6) and w[1] == pytest.approx(2.0)


def test_sampling_is_partition_independent(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 3 == 0).cast("int"))
    a = {r.k for r in SM.sample_n(df.repartition(1), 100, "k").collect()}
    b = {r.k for r in SM.sample_n(df.repartition(7), 100, "k").collect()}
    assert a == b and len(a) == 100
    f1 = {r.k: r.fold for r in SM.stratified_folds(df.repartition(3), "y", "k", 3).collect()}
    f2 = {r.k: r.fold for r in SM.stratified_folds(df.repartition(5), "y", "k", 3).collect()}
    assert f1 == f2
    sizes = SM.stratified_folds(df, "y", "k", 3).groupBy("y", "fold").count().collect()
    per = {}
    for r in sizes:
        per.setdefault(r.y, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in per.values())
    bw = SM.bootstrap_weights(df.limit(2000), "k", 20).groupBy("replicate").agg(F.avg("weight").alias("m")).collect()
    assert all(abs(r.m - 1.0) < 0.1 for r in bw)


def test_numeric_column_rules(spark):
    df = spark.createDataFrame([(1, 0, 7, 0.0, "a", None), (2, 1, 0, 1.0, "b", None)], "n long, flag_S0 int, flag_rate int, flag_x double, flag_text string, flag_none int")
    got = {r["column"]: (r.prefixed, r.other_values, r.by_prefix, r.by_prefix_and_binary) for r in FE.numeric_column_rules(df, ("flag_",)).collect()}
    assert got == {"n": (False, True, True, True), "flag_S0": (True, False, False, False), "flag_rate": (True, True, False, True),
                   "flag_x": (True, False, False, False), "flag_none": (True, False, False, False)}
    for strict, col in ((False, 2), (True, 3)):
        assert FE.numeric_columns(df.drop("flag_none"), ("flag_",), require_binary_for_exclusion=strict) == [c for c, v in got.items() if v[col]]
    assert FE.numeric_column_rules(df.where("false"), ("flag_",)).count() == 5


def test_set_dummies_are_the_long_form_of_the_wide_one(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "new", "y"), (4, None, None)], "k int, c string, d string")
    cats = {"c": ["a", "b"], "d": ["x", "y"]}
    got = FE.set_dummies(FE.one_hot(df, ["c", "d"], cats), ["c", "d"], cats, ["k"])
    assert sorted(map(tuple, got.collect())) == [(1, "c_a"), (1, "d_x"), (2, "c_b"), (3, "d_y")]
    none = {"c": [], "d": []}
    assert FE.set_dummies(FE.one_hot(df, ["c", "d"], none), ["c", "d"], none, ["k"]).count() == 0


def test_one_hot_long_makes_its_records_once(spark, monkeypatch):
    from conftest import SF0001
    from netquery.plans import features_q as Q
    from netquery.plans.derived import connection_records
    made, recs = spark.sparkContext.accumulator(0), connection_records(spark, SF0001)

    @F.udf("string")
    def seen(v):
        made.add(1)
        return v
    monkeypatch.setattr(Q, "connection_records", lambda spark, sf: recs.withColumn("flag", seen.asNondeterministic()("flag")))
    n = recs.count()
    assert Q.q_one_hot_long(spark, SF0001).count() > 2 * n and made.value == n
