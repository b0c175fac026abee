"""EDA and sampling queries: PR1, PR2, AG1-AG4, AG23, SM1-SM4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import poisson1_sql
from ..functions.scalar import attack_label, importance
from ..operators import sampling as SM
from ..operators import stats as ST
from .derived import CONNECTION_SQL, connection_records, line_key, line_key_sql
from .registry import query, rnd, table


@query("value_counts", oracle="SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_value_counts(spark, sf):
    return ST.value_counts(table(spark, sf, "events"), "event_type")


@query("class_balance", oracle="""
SELECT CAST(event_type <> 'view' AS INTEGER) AS label, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1""")
def q_class_balance(spark, sf):
    e = table(spark, sf, "events").select((F.col("event_type") != "view").cast("int").alias("label"))
    return ST.class_balance(e).select("label", "count", rnd("share").alias("share"))


@query("attack_label", oracle=f"""
WITH c AS ({CONNECTION_SQL})
SELECT attack IS NULL AS attack_missing, CASE WHEN attack IS NOT DISTINCT FROM 'normal' THEN 0 ELSE 1 END AS label, count(*) AS n
FROM c GROUP BY ALL""")
def q_attack_label(spark, sf):
    c = connection_records(spark, sf)
    return c.groupBy(F.col("attack").isNull().alias("attack_missing"), attack_label("attack").alias("label")).agg(
        F.count(F.lit(1)).alias("n"))


_IMP = "ln(l_extendedprice + l_quantity + 1)"


def _importance(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_quantity")
    return li.withColumn("importance_score", importance("l_extendedprice", "l_quantity"))


@query("importance_score", oracle=f"""
SELECT l_returnflag, count(*) AS n, round(avg({_IMP}), 6) AS mean_importance,
       round(min({_IMP}), 6) AS min_importance, round(max({_IMP}), 6) AS max_importance FROM lineitem GROUP BY 1""")
def q_importance(spark, sf):
    i = _importance(spark, sf)
    return i.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("importance_score")).alias("mean_importance"),
                                         rnd(F.min("importance_score")).alias("min_importance"),
                                         rnd(F.max("importance_score")).alias("max_importance"))


@query("histogram", oracle=f"""
WITH v AS (SELECT {_IMP} AS v FROM lineitem), r AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((v - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin, lo, hi FROM v, r)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 50), 6) AS lower, round(lo + bin * ((hi - lo) / 50), 6) AS upper, count(*) AS count
FROM b GROUP BY bin, lo, hi""")
def q_histogram(spark, sf):
    h = ST.histogram(_importance(spark, sf), "importance_score", 50)
    return h.select("bin", rnd("lower").alias("lower"), rnd("upper").alias("upper"), "count")


@query("box_stats", oracle=f"""
WITH v AS (SELECT l_returnflag, {_IMP} AS x FROM lineitem),
q AS (SELECT l_returnflag, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif FROM q)
SELECT f.l_returnflag, f.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN x BETWEEN lof AND hif THEN x END), 6) AS lower_whisker,
       round(max(CASE WHEN x BETWEEN lof AND hif THEN x END), 6) AS upper_whisker,
       CAST(count_if(NOT (x BETWEEN lof AND hif)) AS BIGINT) AS outliers
FROM f JOIN v ON f.l_returnflag = v.l_returnflag GROUP BY f.l_returnflag, f.n, q1, median, q3""")
def q_box_stats(spark, sf):
    b = ST.box_stats(_importance(spark, sf), "l_returnflag", "importance_score")
    return b.select("l_returnflag", "n", *[rnd(c).alias(c) for c in ("q1", "median", "q3", "lower_whisker", "upper_whisker")],
                    "outliers")


@query("class_weights", oracle="""
WITH c AS (SELECT CAST(event_type <> 'view' AS INTEGER) AS label, count(*) AS n_c FROM events GROUP BY 1)
SELECT label, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM c""")
def q_class_weights(spark, sf):
    e = table(spark, sf, "events").select((F.col("event_type") != "view").cast("int").alias("label"))
    return ST.class_weights(e).select("label", "n_c", rnd("weight").alias("weight"))


_KEY = line_key_sql()


@query("sample_n", oracle=f"""
SELECT {_KEY} AS row_key, l_extendedprice FROM lineitem
ORDER BY md5({_KEY} || '42'), {_KEY} LIMIT 10000""")
def q_sample_n(spark, sf):
    li = table(spark, sf, "lineitem").select(line_key().alias("row_key"), "l_extendedprice")
    return SM.sample_n(li, 10000, "row_key", 42)


@query("scatter_points", oracle=f"""
WITH c AS ({CONNECTION_SQL}),
s AS (SELECT conn_id, attack, duration, src_bytes FROM c ORDER BY md5(conn_id || '42'), conn_id LIMIT 10000)
SELECT conn_id, attack, duration, src_bytes, round(log10(duration), 6) AS log10_duration, round(log10(src_bytes), 6) AS log10_src_bytes
FROM s WHERE duration > 0 AND src_bytes > 0""")
def q_scatter_points(spark, sf):
    c = connection_records(spark, sf)
    s = SM.scatter_points(c, "duration", "src_bytes", "attack", "conn_id", 10000, 42)
    return s.select("conn_id", "attack", "duration", "src_bytes", rnd("log10_duration").alias("log10_duration"),
                    rnd("log10_src_bytes").alias("log10_src_bytes"))


@query("stratified_folds", oracle="""
SELECT vec_id, CAST(label < 5 AS INTEGER) AS label,
       CAST((row_number() OVER (PARTITION BY label < 5 ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), vec_id) - 1) % 3 AS INTEGER) AS fold
FROM embeddings""")
def q_stratified_folds(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", (F.col("label") < 5).cast("int").alias("label"))
    return SM.stratified_folds(e, "label", "vec_id", 3, 42)


_U_SQL = "(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '42' || CAST(r AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


@query("bootstrap_weights", oracle=f"""
WITH x AS (SELECT vec_id, unnest(generate_series(0, 99)) AS r FROM embeddings),
w AS (SELECT r, {poisson1_sql(_U_SQL)} AS weight FROM x)
SELECT CAST(r AS INTEGER) AS replicate, CAST(sum(weight) AS BIGINT) AS drawn, CAST(count_if(weight > 0) AS BIGINT) AS distinct_rows FROM w GROUP BY r""")
def q_bootstrap_weights(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id")
    b = SM.bootstrap_weights(e, "vec_id", 100, 42)
    return b.groupBy(F.col("replicate").cast("int").alias("replicate")).agg(
        F.sum("weight").cast("long").alias("drawn"), F.count_if(F.col("weight") > 0).alias("distinct_rows"))
