"""Link measures (AG12-AG20, PR10) with the hand goldens."""

import pytest
from pyspark.sql import functions as F

from netquery.functions.scalar import classify_flow
from netquery.operators import fairness as FA
from netquery.operators import netcalc as NC


def test_jain_goldens(spark):
    rows = [("s", 0, "Reno_0", 1), ("s", 0, "Cubic_3", 1), ("s", 0, "BBR_6", 1),
            ("s", 1, "Reno_0", 3), ("s", 1, "Cubic_3", 0), ("s", 1, "BBR_6", 0),
            ("s", 2, "Reno_0", 0), ("s", 2, "Cubic_3", 0), ("s", 2, "BBR_6", 0)]
    df = spark.createDataFrame(rows, "scenario string, t long, client string, throughput long")
    j = {r.t: r.jain for r in FA.jain(df).collect()}
    assert j[0] == pytest.approx(1.0) and j[1] == pytest.approx(1 / 3) and j[2] == 0.0
    assert FA.jain_mean(FA.jain(df)).first().jain_mean == pytest.approx((1 + 1 / 3 + 0) / 3)


def test_densify_and_drops(spark):
    rows = [("s", 0, "Reno_0", 5, 1), ("s", 3, "Reno_0", 2, 0), ("s", 1, "Custom_9", 1, 0), ("s", 2, "Other", 1, 4)]
    df = spark.createDataFrame(rows, "scenario string, t long, client string, throughput long, drops long")
    d = FA.densify(df)
    assert d.count() == 3 * 4
    reno = {r.t: r.throughput for r in d.where("client = 'Reno_0'").collect()}
    assert reno == {0: 5, 1: 0, 2: 0, 3: 2}
    drops = {r.algorithm: r.drops for r in FA.drops_by_algorithm(d).collect()}
    assert drops == {"Reno": 1}          # zero totals and unmatched clients hidden
    assert FA.mean_throughput(d).where("client = 'Reno_0'").first().mean_throughput == pytest.approx(7 / 4)


def test_classify_flow_first_match(spark):
    df = spark.createDataFrame([("Reno_Cubic",), ("BBR_6",), ("x",)], "c string")
    assert [r.a for r in df.select(classify_flow("c").alias("a")).collect()] == ["Reno", "BBR", None]


def test_path_delay_worksheet(spark):
    hops = spark.createDataFrame([("p", 1, 8000.0, 2e6, 2.5e6, 2.5e8)],
                                 "path_id string, hop int, bits double, rate_bps double, dist_m double, speed_mps double")
    r = NC.path_delay(hops).first()
    assert r.transmission_s == pytest.approx(0.004) and r.propagation_s == pytest.approx(0.010)
    assert r.total_s * 1000 == pytest.approx(14.0)
    two = spark.createDataFrame([("q", 1, 8000.0, 1e6, 0.0, 2.5e8), ("q", 2, 8000.0, 2e6, 0.0, 2.5e8)], hops.schema)
    assert NC.path_delay(two).first().transmission_s == pytest.approx(8000 / 1e6 + 8000 / 2e6)   # L/R1 + L/R2


def test_overload(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 3)], "t int, load int")
    assert NC.overload_fraction(df, "load", 2).first().overload_fraction == pytest.approx(0.5)
