"""Small arithmetic helpers shared by reconciliation and metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_diff(s: Column, b: Column) -> Column:
    """|(s - b) / b * 100| in double; NULL when b is 0 or NULL."""
    s, b = s.cast("double"), b.cast("double")
    return F.abs(F.try_divide(s - b, b) * F.lit(100.0))


def throughput(rows: Column, seconds: Column) -> Column:
    """rows / seconds when seconds > 0, else 0."""
    return F.when(seconds > 0, rows.cast("double") / seconds).otherwise(F.lit(0.0))


# Below this magnitude, and this far from the middle between two results, scaling cannot change a rounding.
_PLAIN, _CLEAR = 2.0 ** 44, 0.49


def round_double(c: Column, scale: int = 6) -> Column:
    """Round a double half-up to ``scale`` places; -0.0 becomes 0.0.

    ``F.round`` goes through decimal text.  Where the scaled value is clearly
    nearer to one whole number than to its neighbour, that number over the power of
    ten is the same double; only the others take the long way."""
    x = c.cast("double")
    by_text = F.round(x, scale)
    if not 0 <= scale <= 15:
        return by_text + F.lit(0.0)
    scaled = x * F.lit(10.0 ** scale)
    whole = F.rint(scaled)
    clear = (F.abs(scaled) < _PLAIN) & (F.abs(scaled - whole) < _CLEAR)
    return F.when(clear, whole / F.lit(10.0 ** scale)).otherwise(by_text) + F.lit(0.0)
