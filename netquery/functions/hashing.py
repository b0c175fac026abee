"""Partition-independent pseudo-random numbers from md5, reproducible in SQL.

`rand(seed)` depends on partitioning; md5 of the row key does not, so a
sample, fold or bootstrap replicate is the same on 8 or 8,000 cores and can
be recomputed by an independent SQL engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = float(2 ** 32)


def hash_key(key, seed=42, salt=None) -> Column:
    """md5(cast(key as string) || seed [|| salt]) as a hex string."""
    parts = [F.col(key).cast("string") if isinstance(key, str) else key.cast("string"),
             F.lit(str(seed))]
    if salt is not None:
        parts.append(salt.cast("string") if isinstance(salt, Column) else F.lit(str(salt)))
    return F.md5(F.concat(*parts))


def uniform(key, seed=42, salt=None) -> Column:
    """Uniform in [0, 1) from the first 32 bits of the md5 hex digest."""
    h = hash_key(key, seed, salt)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def poisson1_thresholds(kmax: int = 12) -> list[float]:
    """Cumulative Poisson(1) probabilities P(X <= k), k = 0..kmax-1 (by rule)."""
    out, acc, term = [], 0.0, math.exp(-1.0)
    for k in range(kmax):
        if k > 0:
            term /= k
        acc += term
        out.append(acc)
    return out


def poisson1(u: Column, kmax: int = 12) -> Column:
    """Poisson(1) draw by inverse CDF of a 32-bit uniform column. P(X > 12) is
    6.4e-11, under the 2.3e-10 that the largest such uniform lies below 1, so no
    draw is above 12 and `kmax` cuts nothing off."""
    expr = None
    for k, p in enumerate(poisson1_thresholds(kmax)):
        cond = u < F.lit(p)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(kmax))


def poisson1_sql(u_sql: str, kmax: int = 12) -> str:
    """The same inverse-CDF draw as a SQL CASE expression (for oracles)."""
    whens = " ".join(f"WHEN {u_sql} < {p!r} THEN {k}"
                     for k, p in enumerate(poisson1_thresholds(kmax)))
    return f"(CASE {whens} ELSE {kmax} END)"
