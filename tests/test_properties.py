"""Property tests: the distributed primitives agree with plain pandas/numpy
on random inputs (few examples: each one runs Spark jobs)."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netquery.operators.ordered import running_sum
from netquery.operators.stats import exact_quantiles
from netquery.operators import joins as J

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.integers(0, 3), st.integers(-20, 20), st.integers(0, 5)), min_size=1, max_size=80)


@SETTINGS
@given(rows, st.integers(1, 12))
def test_running_sum_property(spark, data, n_buckets):
    df = spark.createDataFrame(data, "g long, k long, v long").groupBy("g", "k").agg(F.sum("v").alias("v"))
    got = {(r.g, r.k): r.v_cum for r in running_sum(df, "k", ["v"], by=["g"], n_buckets=n_buckets).collect()}
    pdf = pd.DataFrame(data, columns=["g", "k", "v"]).groupby(["g", "k"], as_index=False)["v"].sum()
    for g, k, _ in pdf.itertuples(index=False):
        assert got[(g, k)] == pdf[(pdf.g == g) & (pdf.k <= k)]["v"].sum()


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60))
def test_exact_quantiles_property(spark, data):
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: (r.q0, r.q1, r.q2) for r in exact_quantiles(df, "x", [0.1, 0.5, 0.9], ["g"]).collect()}
    for g in {d[0] for d in data}:
        vals = np.array([x for gg, x in data if gg == g])
        exp = np.percentile(vals, [10, 50, 90])
        assert np.allclose(got[g], exp, rtol=1e-9, atol=1e-6)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 600)), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 600)), min_size=0, max_size=40),
       st.sampled_from([60, 250, 86400]))
def test_asof_property(spark, left, right, bucket):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    L = spark.createDataFrame([(i, k, t0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(left)],
                              "id long, k long, ts timestamp_ntz")
    R = spark.createDataFrame([(j, k, t0 + dt.timedelta(seconds=s)) for j, (k, s) in enumerate(right)] or [(0, -1, t0)],
                              "rid long, k long, rts timestamp_ntz")
    got = {r.id: r.r_rid for r in J.asof_join(L, R, ["k"], "ts", "rts", ["rid"], bucket_seconds=bucket,
                                             right_order="rid").collect()}
    for i, (k, s) in enumerate(left):
        cand = [(rs, j) for j, (kk, rs) in enumerate(right) if kk == k and rs <= s]
        assert got[i] == (max(cand)[1] if cand else None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-400, 4000)), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(0, 2), st.integers(-400, 4000), st.integers(-5, 3000)), min_size=0, max_size=30),
       st.sampled_from([1, 7, 60, 3600]))
def test_interval_join_property(spark, points, intervals, bucket):
    import datetime as dt
    t0 = dt.datetime(1970, 1, 1, 0, 10)            # buckets below and above zero
    P = spark.createDataFrame([(i, k, t0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(points)], "p long, k long, t timestamp_ntz")
    V = spark.createDataFrame([(j, k, t0 + dt.timedelta(seconds=s), t0 + dt.timedelta(seconds=s + d)) for j, (k, s, d) in enumerate(intervals)],
                              "v long, k long, a timestamp_ntz, b timestamp_ntz")
    got = sorted((r.p, r.v) for r in J.interval_join(P, V, "t", "a", "b", bucket_seconds=bucket, on=["k"]).collect())
    assert got == sorted((i, j) for i, (k, s) in enumerate(points) for j, (kk, a, d) in enumerate(intervals) if k == kk and a <= s <= a + d)


def test_long_intervals_cost_few_rows(spark):
    one = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:30' a, timestamp_ntz'2024-12-31 12:00:00' b, 1 v "
                    "UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2023-01-01 00:00:00' b, 2 v UNION ALL SELECT null, null, 3")
    rows = J.dyadic_pieces(one, "a", "b", 60).collect()
    assert {r.v for r in rows} == {1} and len(rows) <= 38
    covered = sorted((r["__cell"] << r["__lvl"], (r["__cell"] + 1) << r["__lvl"]) for r in rows)
    assert all(x[1] == y[0] for x, y in zip(covered, covered[1:]))          # disjoint and without gaps
