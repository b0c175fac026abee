"""Exact running sums over a global order, without a single-partition window.

A window with ORDER BY but no PARTITION BY moves every row into one task.
Here the order key is cut into range buckets (split points from one
`percentile_approx` pass, at most `n_buckets` values reach the driver), the
per-bucket totals (at most n_buckets + 1 rows, so the broadcast is
size-bounded) give each bucket its offset, and the running sum inside a
bucket is a partitioned window.  Callers pre-aggregate to one row per
distinct order value first, so a value that holds a third of all input rows
is one row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_B = "__bucket"


def default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(8, 4 * parts)


def bucket_splits(df: DataFrame, key: str, n_buckets: int) -> list[float]:
    """Approximate n-quantile split points of `key` (bounded list)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(key).cast("double"), probs, 10000).alias("s")).first()
    splits = row["s"] if row and row["s"] else []
    return sorted(set(float(s) for s in splits if s is not None))


def bucket_of(key_col, splits: list[float]):
    """Number of split points strictly below the key: monotone in the key."""
    if not splits:
        return F.lit(0)
    arr = F.array(*[F.lit(s) for s in splits])
    k = key_col.cast("double")
    # binary search: log2 of the splits in comparisons a row; a step beyond the array compares with null
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(splits).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(arr, at + step - 1) < k, at + step).otherwise(at))


def running_sum(df: DataFrame, order, values: list[str], *, by=(), descending: bool = False,
                inclusive: bool = True, suffix: str = "_cum", peers: bool = True,
                n_buckets: int | None = None) -> DataFrame:
    """Add `<v><suffix>` = sum of v over the rows before (and, if inclusive, at)
    each row, within `by` groups, in `order`.

    `order` is a numeric column or a list whose first element is numeric (it
    defines the buckets) followed by tie-breakers. With peers=True rows that
    tie on the whole order share one value (range frame); with peers=False the
    frame is row by row (needs a total order)."""
    order = [order] if isinstance(order, str) else list(order)
    by = list(by)
    n = n_buckets or default_buckets(df)
    okey = "__okey"
    first = F.col(order[0])
    base = df.withColumn(okey, (-first if descending else first).cast("double"))
    splits = bucket_splits(base, okey, n)
    b = base.withColumn(_B, bucket_of(F.col(okey), splits))
    totals = b.groupBy(*by, _B).agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*by).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, _B, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__off_{v}")
                                       for v in values])
    # offsets: one row per (group, bucket); without groups it is at most n+1 rows
    b = (b.join(F.broadcast(offsets), [*by, _B], "left") if not by
         else b.join(offsets, [*by, _B], "left"))
    tail = [(F.col(c).desc() if descending else F.col(c).asc()) for c in order[1:]]
    ow = Window.partitionBy(*by, _B).orderBy(F.col(okey).asc(), *tail)
    w = (ow.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers and not tail
         else ow.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = b
    for v in values:
        inner = F.coalesce(F.sum(v).over(w), F.lit(0))
        if not inclusive:
            inner = inner - F.coalesce(F.col(v), F.lit(0)) if (tail or not peers) else \
                inner - F.coalesce(F.sum(v).over(Window.partitionBy(*by, _B, okey)), F.lit(0))
        out = out.withColumn(v + suffix, inner + F.col(f"__off_{v}"))
    return out.drop(_B, okey, *[f"__off_{v}" for v in values])


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a single-row aggregate to every row: a broadcast
    equi-join on a constant key (the broadcast side is exactly one row)."""
    return (df.withColumn("__one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one").drop("__one"))


def time_bucket(epoch_col, width_seconds: int):
    return F.floor(epoch_col.cast("double") / F.lit(float(width_seconds))).cast("long")


def bucketed_lag(df: DataFrame, keys: list[str], epoch: str, order: list[str],
                 width_seconds: int = 86400, out: str = "prev_epoch") -> DataFrame:
    """Previous `epoch` within `keys` in `order`, with the window partitioned by
    (keys, time bucket) so one hot key is spread over its buckets; the first
    row of a bucket takes the last epoch of the key's previous non-empty bucket
    (one summary row per (key, bucket))."""
    b = "__tb"
    x = df.withColumn(b, time_bucket(F.col(epoch), width_seconds))
    w = Window.partitionBy(*keys, b).orderBy(*order)
    x = x.withColumn(out, F.lag(epoch).over(w))
    last = x.groupBy(*keys, b).agg(F.max(epoch).alias("__last"))
    carry = last.withColumn("__carry", F.lag("__last").over(Window.partitionBy(*keys).orderBy(b)))
    x = x.join(carry.select(*keys, b, "__carry"), [*keys, b], "left")
    return x.withColumn(out, F.coalesce(F.col(out), F.col("__carry"))).drop(b, "__carry")
