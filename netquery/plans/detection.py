"""Metric queries (AG5-AG11, ST1-ST3, WN7, IO6) on driver tables.

Stand-in for the detection test set: documents joined with labels;
label = quality, score = n_chars, rule prediction = n_chars > 1000.
Languages play the role of competing models for the leaderboard ops.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_div
from ..operators import metrics as M
from .registry import query, rnd, table

THRESHOLD = 1000

_SCORED_SQL = f"""
  SELECT d.doc_id, d.lang, d.source, CAST(l.quality AS INTEGER) AS label,
         CAST(d.n_chars AS DOUBLE) AS score,
         CASE WHEN d.n_chars > {THRESHOLD} THEN 1 ELSE 0 END AS prediction
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def scored(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return (d.join(lab, "doc_id")
            .select("doc_id", "lang", "source", F.col("quality").cast("int").alias("label"),
                    F.col("n_chars").cast("double").alias("score"),
                    (F.col("n_chars") > THRESHOLD).cast("int").alias("prediction")))


_RATES_SQL = """
    CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
    round(coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
    round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision,
    round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2.0 * (coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) * coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0))
        / nullif(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) + coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 0), 0), 6) AS f1"""

_COUNTS_SQL = """
    count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
    count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn"""


def _round_rates(df, keep=()):
    return df.select(*keep, "tp", "fp", "fn", "tn", *[rnd(c).alias(c) for c in
                                                      ("accuracy", "precision", "recall", "f1")])


@query("binary_metrics", oracle=f"""
WITH s AS ({_SCORED_SQL}), c AS (SELECT {_COUNTS_SQL} FROM s)
SELECT {_RATES_SQL} FROM c""")
def q_binary_metrics(spark, sf):
    return _round_rates(M.binary_metrics(scored(spark, sf)))


@query("confusion_matrix", oracle=f"""
WITH s AS ({_SCORED_SQL}), c AS (SELECT {_COUNTS_SQL} FROM s)
SELECT 'Real_Normal' AS actual, CAST(tn AS BIGINT) AS Pred_Normal, CAST(fp AS BIGINT) AS Pred_Ataque FROM c
UNION ALL
SELECT 'Real_Ataque', CAST(fn AS BIGINT), CAST(tp AS BIGINT) FROM c""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(scored(spark, sf))


@query("classification_report", oracle=f"""
WITH s AS ({_SCORED_SQL}), c AS (SELECT {_COUNTS_SQL} FROM s),
r AS (SELECT
  coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0) AS pn, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS rn,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS pa, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS ra,
  CAST(tn + fp AS DOUBLE) AS sn, CAST(tp + fn AS DOUBLE) AS sa, tp, fp, fn, tn FROM c),
f AS (SELECT *, coalesce(2 * pn * rn / nullif(pn + rn, 0), 0) AS fn_, coalesce(2 * pa * ra / nullif(pa + ra, 0), 0) AS fa FROM r)
SELECT 'Normal' AS class, round(pn, 6) AS precision, round(rn, 6) AS recall, round(fn_, 6) AS f1_score, CAST(sn AS BIGINT) AS support FROM f
UNION ALL SELECT 'Ataque', round(pa, 6), round(ra, 6), round(fa, 6), CAST(sa AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(coalesce((tp + tn) / nullif(sn + sa, 0), 0), 6), CAST(sn + sa AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((pn + pa) / 2, 6), round((rn + ra) / 2, 6), round((fn_ + fa) / 2, 6), CAST(sn + sa AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(coalesce((pn * sn + pa * sa) / nullif(sn + sa, 0), 0), 6),
  round(coalesce((rn * sn + ra * sa) / nullif(sn + sa, 0), 0), 6),
  round(coalesce((fn_ * sn + fa * sa) / nullif(sn + sa, 0), 0), 6), CAST(sn + sa AS BIGINT) FROM f""")
def q_classification_report(spark, sf):
    r = M.classification_report(scored(spark, sf))
    return r.select("class", *[rnd(c).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@query("roc_auc", oracle=f"""
WITH s AS ({_SCORED_SQL}),
g AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM s GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
             THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END, 6) AS roc_auc FROM c""")
def q_roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf)).select(rnd("roc_auc").alias("roc_auc"))


_CUM_SQL = f"""
WITH s AS ({_SCORED_SQL}),
g AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM s GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS pos_cum, sum(neg) OVER (ORDER BY score DESC) AS neg_cum,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N, pos FROM g)"""


@query("roc_curve", oracle=f"""{_CUM_SQL}
SELECT score AS threshold, round(coalesce(neg_cum / nullif(N, 0), 0), 6) AS fpr,
       round(coalesce(pos_cum / nullif(P, 0), 0), 6) AS tpr FROM c
UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0""")
def q_roc_curve(spark, sf):
    r = M.roc_curve(scored(spark, sf))
    return r.select("threshold", rnd("fpr").alias("fpr"), rnd("tpr").alias("tpr"))


@query("pr_curve", oracle=f"""{_CUM_SQL}
SELECT score AS threshold, round(coalesce(pos_cum / nullif(pos_cum + neg_cum, 0), 0), 6) AS precision,
       round(coalesce(pos_cum / nullif(P, 0), 0), 6) AS recall FROM c
UNION ALL SELECT 'Infinity'::DOUBLE, 1.0, 0.0""")
def q_pr_curve(spark, sf):
    r = M.pr_curve(scored(spark, sf))
    return r.select("threshold", rnd("precision").alias("precision"), rnd("recall").alias("recall"))


@query("average_precision", oracle=f"""{_CUM_SQL}
SELECT round(CASE WHEN sum(pos) > 0 THEN sum(pos * (pos_cum / (pos_cum + neg_cum))) / sum(pos) END, 6)
       AS average_precision FROM c""")
def q_average_precision(spark, sf):
    return M.average_precision(scored(spark, sf)).select(rnd("average_precision").alias("average_precision"))


@query("regression_metrics", oracle="""
WITH j AS (SELECT l.l_returnflag, l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS p
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT l_returnflag, round(avg((y - p) * (y - p)), 4) AS mse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2
FROM j GROUP BY l_returnflag""")
def q_regression_metrics(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_quantity", "l_extendedprice")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = li.join(p, "l_partkey").select("l_returnflag", F.col("l_extendedprice").alias("label"),
                                       (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction"))
    r = M.regression_metrics(j, by=["l_returnflag"])
    return r.select("l_returnflag", rnd("mse", 4).alias("mse"), rnd("r2").alias("r2"))


# ---- leaderboard family: one "model" per language ----

def lang_results(spark, sf):
    return (M.binary_metrics(scored(spark, sf), by=["lang"])
            .select(F.col("lang").alias("model"), "accuracy", "precision", "recall", "f1"))


_LANG_SQL = f"""
WITH s AS ({_SCORED_SQL}),
c AS (SELECT lang AS model, {_COUNTS_SQL} FROM s GROUP BY lang),
m AS (SELECT model, coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy,
        coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
        coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall, tp, fp, fn FROM c),
r AS (SELECT model, accuracy, precision, recall,
        coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m)"""


def _ranked(df):
    w = Window.orderBy(F.col("f1").desc(), F.col("accuracy").desc(), F.col("model").asc())
    return df.withColumn("rank", F.row_number().over(w).cast("long"))


def _round_board(df, extra=()):
    return df.select("model", *extra, *[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("leaderboard", oracle=f"""{_LANG_SQL}
SELECT row_number() OVER (ORDER BY f1 DESC, accuracy DESC, model ASC) AS rank, model,
       round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM r""")
def q_leaderboard(spark, sf):
    return _round_board(_ranked(M.leaderboard(lang_results(spark, sf))), ["rank"])


@query("topk_models", oracle=f"""{_LANG_SQL}
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM r ORDER BY f1 DESC, accuracy DESC, model LIMIT 3""")
def q_topk_models(spark, sf):
    return _round_board(M.topk(lang_results(spark, sf), 3))


@query("union_results", oracle=f"""
WITH s AS ({_SCORED_SQL}),
c AS (SELECT 'lang:' || lang AS model, 'base' AS phase, {_COUNTS_SQL} FROM s GROUP BY lang
      UNION ALL SELECT 'source:' || source, 'ensembles', {_COUNTS_SQL} FROM s GROUP BY source)
SELECT model, phase, round(coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       CAST(NULL AS DOUBLE) AS roc_auc FROM c""")
def q_union_results(spark, sf):
    s = scored(spark, sf)
    cols = ["accuracy", "precision", "recall", "f1"]
    a = (M.binary_metrics(s, by=["lang"])
         .select(F.concat(F.lit("lang:"), "lang").alias("model"), F.lit("base").alias("phase"), *cols)
         .withColumn("roc_auc", F.lit(None).cast("double")))
    b = (M.binary_metrics(s, by=["source"])
         .select(F.concat(F.lit("source:"), "source").alias("model"), F.lit("ensembles").alias("phase"), *cols))
    u = M.union_results(a, b)
    return u.select("model", "phase", *[rnd(c).alias(c) for c in cols], "roc_auc")


@query("argmax_first", oracle=f"""{_LANG_SQL}
SELECT model, round(accuracy, 6) AS accuracy FROM r ORDER BY accuracy DESC, model ASC LIMIT 1""")
def q_argmax_first(spark, sf):
    b = M.argmax_first(lang_results(spark, sf), "accuracy", "model")
    return b.select("model", rnd("accuracy").alias("accuracy"))


def _ratio_4dp(num, den):
    """Exact half-up 4-decimal rendering of an integer ratio num/den in [0, 1]."""
    q = F.floor((F.lit(20000) * num + den) / (F.lit(2) * den)).cast("long")
    return F.when(den == 0, F.lit("0.0000")).otherwise(
        F.concat((q / 10000).cast("long").cast("string"), F.lit("."),
                 F.lpad((q % 10000).cast("string"), 4, "0")))


@query("report_top5_md", oracle=f"""
WITH s AS ({_SCORED_SQL}),
c AS (SELECT lang AS model, {_COUNTS_SQL} FROM s GROUP BY lang),
r AS (SELECT model, 2 * tp AS f1n, 2 * tp + fp + fn AS f1d, tp + tn AS an, tp + fp + fn + tn AS ad,
             coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
             coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy FROM c),
t AS (SELECT *, row_number() OVER (ORDER BY f1 DESC, accuracy DESC, model) AS rk FROM r),
f AS (SELECT rk, model,
        CASE WHEN f1d = 0 THEN '0.0000' ELSE (CAST(floor((20000 * f1n + f1d) / (2 * f1d)) AS BIGINT) // 10000)::VARCHAR || '.' ||
             lpad((CAST(floor((20000 * f1n + f1d) / (2 * f1d)) AS BIGINT) % 10000)::VARCHAR, 4, '0') END AS f1s,
        CASE WHEN ad = 0 THEN '0.0000' ELSE (CAST(floor((20000 * an + ad) / (2 * ad)) AS BIGINT) // 10000)::VARCHAR || '.' ||
             lpad((CAST(floor((20000 * an + ad) / (2 * ad)) AS BIGINT) % 10000)::VARCHAR, 4, '0') END AS accs
      FROM t WHERE rk <= 5)
SELECT 1 AS line_no, '# Resumen de Resultados (Top-5)' AS line
UNION ALL SELECT 2, '' UNION ALL SELECT 3, '| Modelo | F1 | Accuracy |' UNION ALL SELECT 4, '|---|---:|---:|'
UNION ALL SELECT CAST(4 + rk AS INTEGER), '| ' || model || ' | ' || f1s || ' | ' || accs || ' |' FROM f""")
def q_report_top5_md(spark, sf):
    from ..sources.sinks import topk_markdown_lines
    s = scored(spark, sf)
    c = M.confusion_counts(s, by=["lang"]).withColumnRenamed("lang", "model")
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    r = c.select("model",
                 safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                 safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                 _ratio_4dp(2 * tp, 2 * tp + fp + fn).alias("f1_text"),
                 _ratio_4dp(tp + tn, tp + fp + fn + tn).alias("accuracy_text"))
    return topk_markdown_lines(r, k=5)
