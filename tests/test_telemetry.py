"""Telemetry parsing (TX1-TX3, PR8, PR9), tick gaps and latest record."""

import datetime as dt

from pyspark.sql import functions as F

from netquery.functions import text as TX
from netquery.functions.scalar import tag_message
from netquery.operators import telemetry as TEL


def _lines(spark, lines):
    return spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")


def test_parse_cases(spark):
    lines = [
        "DATA 1800000005 TEMP=11.2;HUM=47.9",
        "[Servidor] DATA 1800000020 TEMP=6.4;HUM=20.1",
        "DATA 1799990000 TEMP=12.5;HUM=33.0;PRES=987.5;WIND=4.5",
        "DATA 1800000035 TEMP=4z1.0;HUM=52.5",          # broken number
        "DATA 1800000050",                               # empty payload
        "DATA 1800000065 TEMP=75.0;HUM=140.0",          # over the clamp
        "DATA 1800000080 TEMP=1.0;TEMP=2.0",             # repeated key: last wins
        "ERROR Rate limit DATA 1",                       # ERROR takes precedence
        "MOVE_SUCCESS UP",
        "DATA notanumber TEMP=1.0",
        "DATA -5 TEMP=1.0",
        "DATA 100000000000000000 TEMP=1.0",
    ]
    p = TEL.with_readings(TX.parse_telemetry(_lines(spark, lines), "value"))
    got = {r.i: r for r in p.collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 6, 9, 10, 11}      # every DATA line, with or without a usable time
    assert (got[9].epoch, got[9].ts, got[9].temp) == (None, None, 1.0)
    assert (got[10].epoch, got[10].ts) == (-5, dt.datetime(1969, 12, 31, 23, 59, 55)) and (got[11].epoch, got[11].ts) == (10 ** 17, None)
    assert (got[0].epoch, got[0].temp, got[0].hum) == (1800000005, 11.2, 47.9)
    assert got[0].ts == dt.datetime(2027, 1, 15, 8, 0, 5)
    assert got[1].temp == 6.4
    assert got[2].vars == {"TEMP": 12.5, "HUM": 33.0, "PRES": 987.5, "WIND": 4.5}
    assert got[3].temp is None and got[3].hum == 52.5
    assert got[4].vars == {}
    assert (got[5].temp_display, got[5].hum_display) == (50.0, 100.0)
    assert got[6].temp == 2.0
    long = TX.explode_vars(TX.parse_telemetry(_lines(spark, lines[2:3]), "value"))
    assert sorted(r.var for r in long.collect()) == ["HUM", "PRES", "TEMP", "WIND"]


def test_tag_precedence(spark):
    df = spark.createDataFrame([("ERROR MOVE_X DATA ",), ("MOVE UP DATA ",), ("DATA 1 T=1",), ("PONG",)], "m string")
    assert [r.t for r in df.select(tag_message("m").alias("t")).collect()] == ["ERROR", "MOVE", "DATA", None]


def test_log_gaps_and_latest(spark):
    # a log in the reference's form: 440 ticks, 15 s cadence with seven 16 s steps
    epochs, t = [], 1800000005
    for k in range(440):
        epochs.append(t)
        t += 16 if k in (47, 100, 150, 200, 250, 300, 350) else 15
    lines = [f"DATA {e} TEMP={(k * 7) % 300 / 10:.1f};HUM={(k * 13) % 1000 / 10:.1f}" for k, e in enumerate(epochs)]
    p = TX.parse_telemetry(_lines(spark, lines), "value")
    g = {r.gap: r["count"] for r in TEL.tick_gaps(p, bucket_seconds=600).groupBy("gap").count().collect()}
    assert g == {None: 1, 15: 432, 16: 7}
    last = TEL.latest(TEL.with_readings(p), cols=("epoch", "temp")).first()
    assert last.epoch == epochs[-1]


def test_format_data_replies(spark):
    df = spark.createDataFrame([(None,), ("ALL",), ("TEMP",), ("HUM",), ("PRES",)], "v string")
    out = df.select(TX.format_data(F.lit(1799990000), F.lit(12.5), F.lit(33.0), F.col("v")).alias("r"))
    assert [r.r for r in out.collect()] == [
        "DATA 1799990000 TEMP=12.5;HUM=33.0", "DATA 1799990000 TEMP=12.5;HUM=33.0",
        "DATA 1799990000 TEMP=12.5", "DATA 1799990000 HUM=33.0", "ERROR Unknown var"]


def test_select_var_on_parsed_map(spark):
    p = TX.parse_telemetry(_lines(spark, ["DATA 5 TEMP=1.5;HUM=2.5;PRES=3.0"]), "value")
    got = {v: TX.select_var(p, v).first() for v in (None, "ALL", "TEMP", "HUM", "PRES")}
    assert got[None].selected == {"TEMP": 1.5, "HUM": 2.5, "PRES": 3.0} and got["ALL"].error is None
    assert got["TEMP"].selected == {"TEMP": 1.5} and got["HUM"].selected == {"HUM": 2.5}
    assert got["PRES"].selected is None and got["PRES"].error == "ERROR Unknown var"


def test_render_topk_report(spark):
    import uuid
    from netquery.session import scratch_path
    from netquery.sources.sinks import render_topk_md
    res = spark.createDataFrame([("A", 0.5, 0.9), ("B", 0.80104, 0.8), ("C", 0.7, 0.7)],
                                "model string, f1 double, accuracy double")
    path = scratch_path(spark, f"md-{uuid.uuid4().hex}")
    render_topk_md(res, path, k=2)
    assert [r.value for r in spark.read.text(path).collect()] == [
        "# Resumen de Resultados (Top-5)", "", "| Modelo | F1 | Accuracy |", "|---|---:|---:|",
        "| B | 0.8010 | 0.8000 |", "| C | 0.7000 | 0.7000 |"]
