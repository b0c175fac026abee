"""Scalar column functions: labels, scores, clamps, message tags, flow classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
NORMAL_LABEL = "normal"
# Flow classes in match order (first substring wins).
FLOW_CLASSES = ["Reno", "Cubic", "BBR", "Custom"]
# Display clamps: TEMP to [0, 50], HUM to [0, 100].
CLAMPS = {"TEMP": (0.0, 50.0), "HUM": (0.0, 100.0)}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default=0.0) -> Column:
    """num / den, `default` when den is 0 or null (ANSI mode safe)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(default))


def attack_label(attack="attack") -> Column:
    """PR1: 0 iff attack == 'normal'; 1 otherwise, including a missing attack."""
    return (~_c(attack).eqNullSafe(F.lit(NORMAL_LABEL))).cast("int")


def importance(a="src_bytes", b="dst_bytes") -> Column:
    """PR2: ln(a + b + 1)."""
    return F.log1p(_c(a).cast("double") + _c(b).cast("double"))


def clamp(c, lo: float, hi: float) -> Column:
    """PR8: greatest(lo, least(hi, x)); null stays null."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(c).cast("double")))


def tag_message(msg="line") -> Column:
    """PR9: ERROR > MOVE (`MOVE_` or `MOVE `) > DATA, else null."""
    m = _c(msg)
    return (F.when(m.contains("ERROR"), F.lit("ERROR"))
            .when(m.contains("MOVE_") | m.contains("MOVE "), F.lit("MOVE"))
            .when(m.contains("DATA "), F.lit("DATA")))


def classify_flow(client="client") -> Column:
    """PR10: algorithm of a client id by first substring match; null if none."""
    c = _c(client)
    expr = None
    for name in FLOW_CLASSES:
        cond = c.contains(name)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a timestamp (wall clock for NTZ)."""
    c = _c(ts).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
