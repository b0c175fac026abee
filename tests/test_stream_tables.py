"""Streams read a table of one file or of many, in one or several micro-batches."""

import pytest

from conftest import SF0001
from netquery.session import scratch_path
from netquery.streaming import ops as S


@pytest.mark.parametrize("files, per_batch", [(3, None), (3, 1)])
def test_stream_over_a_folder_of_files(spark, files, per_batch):
    import uuid
    base = scratch_path(spark, f"table-{uuid.uuid4().hex}")
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    events.repartition(files).write.parquet(f"{base}/events.parquet")
    got = S.run_append(S.events_stream(spark, base, max_files=per_batch).select("event_id"), spark, "many")
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in events.select("event_id").collect())


def test_stream_over_one_file(spark):
    got = S.run_append(S.events_stream(spark, SF0001).select("event_id"), spark, "one")
    assert got.count() == spark.read.parquet(f"{SF0001}/events.parquet").count()


def test_predictions_align_by_unique_key(spark):
    from netquery.operators.joins import join_predictions
    labels = spark.createDataFrame([(1, 0), (2, 1)], "row_id int, label int")
    good = spark.createDataFrame([(2, 1.0), (1, 0.0)], "row_id int, prediction double")
    assert sorted((r.row_id, r.label, r.prediction) for r in join_predictions(labels, good).collect()) == [(1, 0, 0.0), (2, 1, 1.0)]
    twice = good.unionByName(good.where("row_id = 1"))
    with pytest.raises(Exception, match="several predictions"):
        join_predictions(labels, twice).collect()


def test_session_state_of_many_sessions_in_few_groups_over_several_batches(spark):
    """Every command's admin flag and number in its session, as a batch query gives them; 3 groups hold all sessions."""
    import uuid

    from pyspark.sql import Window
    from pyspark.sql import functions as F
    base = scratch_path(spark, f"table-{uuid.uuid4().hex}")
    # (hour, id, session, admin login): the files come one after the other in time
    rows = [(h, 10 * h + i, f"s{(h + i) % 7}", (3 * h + i) % 5 == 0) for h in range(9) for i in range(6)] + [(9, 95, None, True), (9, 96, None, False)]
    for part in range(3):
        some = [(h, i, s, "LOGIN ADMIN admin" if a else "PING") for h, i, s, a in rows if min(h // 3, 2) == part]
        c = spark.createDataFrame(some, "h int, cmd_id long, session_id string, line string")
        c.select("cmd_id", "session_id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h)").alias("ts"), "line").coalesce(1).write.mode("append").parquet(f"{base}/c.parquet")
    stream = spark.readStream.schema(spark.read.parquet(f"{base}/c.parquet").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/c.parquet")
    got = S.run_append(S.session_state_stream(stream, buckets=3), spark, "state").collect()
    known = spark.createDataFrame(rows, "h int, cmd_id long, session_id string, a boolean")
    w = Window.partitionBy("session_id").orderBy("h", "cmd_id")
    want = known.select("cmd_id", "session_id", F.coalesce(F.max(F.col("a").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("is_admin"),
                        F.row_number().over(w).cast("long").alias("n_commands")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted(map(tuple, want), key=lambda r: r[0])
