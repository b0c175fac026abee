"""Model-quality metrics as aggregates (AG5-AG11) and leaderboard ops (ST1-ST3, WN7).

Every metric is one pass of partial (map-side) aggregation; curves
pre-aggregate by distinct score and use the bucketed running sum, so no
step gathers the table into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_div
from .ordered import attach_row, running_sum

# Fixed values that must equal the reference's (row and column labels).
CM_ROWS = ("Real_Normal", "Real_Ataque")
CM_COLS = ("Pred_Normal", "Pred_Ataque")
CLASS_NAMES = ("Normal", "Ataque")


def _counts(label: str, pred: str):
    y, p = F.col(label), F.col(pred)
    return [F.count_if((y == 1) & (p == 1)).alias("tp"),
            F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"),
            F.count_if((y == 0) & (p == 0)).alias("tn")]


def confusion_counts(df: DataFrame, label="label", pred="prediction", by=()) -> DataFrame:
    """tp, fp, fn, tn (attack class positive), optionally per group."""
    by = list(by)
    return (df.groupBy(*by) if by else df).agg(*_counts(label, pred))


def confusion_matrix(df: DataFrame, label="label", pred="prediction", by=()) -> DataFrame:
    """AG5: 2 rows (Real_Normal, Real_Ataque) x (Pred_Normal, Pred_Ataque); missing cells 0."""
    by = list(by)
    c = confusion_counts(df, label, pred, by)
    stack = (f"stack(2, '{CM_ROWS[0]}', tn, fp, '{CM_ROWS[1]}', fn, tp) "
             f"as (actual, {CM_COLS[0]}, {CM_COLS[1]})")
    return c.select(*by, F.expr(stack))


def _rates(c: DataFrame, keep=()) -> DataFrame:
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    prec = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(*keep, "tp", "fp", "fn", "tn",
                    safe_div(F.col("tp") + F.col("tn"), n).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    safe_div(2 * prec * rec, prec + rec).alias("f1"))


def binary_metrics(df: DataFrame, label="label", pred="prediction", by=()) -> DataFrame:
    """AG6: accuracy and attack-class precision/recall/F1, zero_division=0."""
    by = list(by)
    return _rates(confusion_counts(df, label, pred, by), by)


def classification_report(df: DataFrame, label="label", pred="prediction") -> DataFrame:
    """AG7: per-class precision/recall/f1/support + accuracy, macro and weighted avg."""
    c = confusion_counts(df, label, pred)
    n = "(tp + fp + fn + tn)"

    def prf(tp, fp, fn):
        p = f"coalesce(try_divide(cast({tp} as double), {tp} + {fp}), 0D)"
        r = f"coalesce(try_divide(cast({tp} as double), {tp} + {fn}), 0D)"
        f = f"coalesce(try_divide(2D * {p} * {r}, {p} + {r}), 0D)"
        return p, r, f

    pn, rn, fnm = prf("tn", "fn", "fp")       # class 0: "positive" = normal
    pa, ra, fa = prf("tp", "fp", "fn")        # class 1: attack
    sn, sa = "(tn + fp)", "(tp + fn)"
    acc = f"coalesce(try_divide(cast(tp + tn as double), {n}), 0D)"
    w = lambda a, b: f"coalesce(try_divide({a} * {sn} + {b} * {sa}, cast({n} as double)), 0D)"
    rows = [
        f"'{CLASS_NAMES[0]}', {pn}, {rn}, {fnm}, {sn}",
        f"'{CLASS_NAMES[1]}', {pa}, {ra}, {fa}, {sa}",
        f"'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), {acc}, {n}",
        f"'macro avg', ({pn} + {pa}) / 2, ({rn} + {ra}) / 2, ({fnm} + {fa}) / 2, {n}",
        f"'weighted avg', {w(pn, pa)}, {w(rn, ra)}, {w(fnm, fa)}, {n}",
    ]
    expr = f"stack(5, {', '.join(rows)}) as (class, precision, recall, f1_score, support)"
    return c.select(F.expr(expr)).select("class", "precision", "recall", "f1_score",
                                         F.col("support").cast("long").alias("support"))


def _score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label)
    return (df.where(F.col(score).isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def roc_auc(df: DataFrame, label="label", score="score") -> DataFrame:
    """AG8: rank-sum AUC, ties counted half; null when one class is absent."""
    g = _score_groups(df, label, score)
    g = running_sum(g, "score", ["neg"], inclusive=False, suffix="_below")
    a = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
              F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("S"))
    return a.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                           F.col("S") / (F.col("P") * F.col("N"))).alias("roc_auc"))


def _cum_desc(df: DataFrame, label: str, score: str) -> DataFrame:
    g = _score_groups(df, label, score)
    g = running_sum(g, "score", ["pos", "neg"], descending=True, inclusive=True, suffix="_cum")
    return g


def _class_totals(df: DataFrame, label: str, score: str) -> DataFrame:
    return (df.where(F.col(score).isNotNull())
            .agg(F.count_if(F.col(label) == 1).alias("P"), F.count_if(F.col(label) == 0).alias("N")))


def roc_curve(df: DataFrame, label="label", score="score") -> DataFrame:
    """AG9: (threshold, fpr, tpr) per distinct score, plus the (inf, 0, 0) origin."""
    g = _cum_desc(df, label, score)
    tot = _class_totals(df, label, score)   # one row: broadcast is size-bounded
    pts = attach_row(g, tot).select(
        F.col("score").alias("threshold"),
        safe_div(F.col("neg_cum"), F.col("N")).alias("fpr"),
        safe_div(F.col("pos_cum"), F.col("P")).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def pr_curve(df: DataFrame, label="label", score="score") -> DataFrame:
    """AG10: (threshold, precision, recall) per distinct score, plus (inf, 1, 0)."""
    g = _cum_desc(df, label, score)
    tot = _class_totals(df, label, score)
    pts = attach_row(g, tot).select(
        F.col("score").alias("threshold"),
        safe_div(F.col("pos_cum"), F.col("pos_cum") + F.col("neg_cum")).alias("precision"),
        safe_div(F.col("pos_cum"), F.col("P")).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, label="label", score="score") -> DataFrame:
    """AG10: AP = sum over thresholds of (recall step) x precision = sum pos_s/P * prec_s."""
    g = _cum_desc(df, label, score)
    prec = safe_div(F.col("pos_cum"), F.col("pos_cum") + F.col("neg_cum"))
    a = g.agg(F.sum("pos").alias("P"), F.sum(F.col("pos") * prec).alias("S"))
    return a.select(F.when(F.col("P") > 0, F.col("S") / F.col("P")).alias("average_precision"))


def regression_metrics(df: DataFrame, label="label", pred="prediction", by=()) -> DataFrame:
    """AG11: MSE and R^2 = 1 - SSE / SST (one aggregation)."""
    by = list(by)
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    a = (df.groupBy(*by) if by else df).agg(
        F.avg((y - p) * (y - p)).alias("mse"),
        F.sum((y - p) * (y - p)).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"))
    return a.select(*by, "mse", (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))


# ---- leaderboard (tables with one row per model: bounded by model count) ----

def leaderboard(df: DataFrame) -> DataFrame:
    """ST1: F1 desc, accuracy desc, model name as final tie-break."""
    return df.orderBy(F.col("f1").desc(), F.col("accuracy").desc(), F.col("model").asc())


def topk(df: DataFrame, k: int) -> DataFrame:
    """ST2: the first k of the leaderboard order (TakeOrderedAndProject)."""
    return leaderboard(df).limit(k)


def union_results(*dfs: DataFrame) -> DataFrame:
    """ST3: row union by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def argmax_first(df: DataFrame, metric: str, order: str, by=()) -> DataFrame:
    """WN7: best row by metric; the earliest (by `order`) of equals wins (strict >).
    Without groups it is a top-1 (one row of each task reaches the last one); with
    groups Spark's window group limit keeps one row of each before the shuffle."""
    best = [F.col(metric).desc(), F.col(order).asc()]
    if not by:
        return df.orderBy(*best).limit(1)
    w = Window.partitionBy(*by).orderBy(*best)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
