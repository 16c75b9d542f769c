"""Sums of doubles that do not depend on the order of the rows.

A double is split into five whole-number limbs of 24 bits (weights 2^24 down
to 2^-72).  Limbs are summed as longs, in any order and over any number of
levels of aggregation, and only the final total is rounded, once, to the
nearest double.  All of it is built-in arithmetic, so partial aggregation and
code generation stay as for a plain sum.

Values of 2^48 and more, infinities and NaN are summed as doubles beside the
limbs; bits below 2^-72 are cut off.  A group may hold 2^38 rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a limb, limbs, and the largest magnitude they hold.
LIMB_BITS, LIMBS, LARGEST = 24, 5, 2.0 ** 48
_SCALE, _MASK = 2.0 ** LIMB_BITS, 2 ** LIMB_BITS - 1


def _names(prefix: str) -> list[str]:
    return [f"{prefix}_{k}" for k in range(LIMBS)] + [f"{prefix}_n", f"{prefix}_rest"]


def split(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with the columns of each value's limbs, named by its keyword."""
    add = {}
    for prefix, value in values.items():
        x = value.cast("double")
        inside = F.abs(x) < LARGEST
        left = F.when(inside, x) / _SCALE
        for k in range(LIMBS):
            limb = left.cast("long")
            add[f"{prefix}_{k}"] = F.coalesce(limb, F.lit(0))
            left = (left - limb) * _SCALE
        add[f"{prefix}_n"] = x.isNotNull().cast("long")
        add[f"{prefix}_rest"] = F.when(~inside, x)
    return df.withColumns(add)


def sums(*prefixes: str) -> list[Column]:
    """Aggregates of the limbs, under the same names: for rows and for sums alike."""
    return [F.sum(n).alias(n) for p in prefixes for n in _names(p)]


def _decimal(limbs: list[Column]) -> Column:
    """Whole number with these limbs, highest first."""
    out = F.lit(Decimal(0)).cast("decimal(38,0)")
    for k, limb in enumerate(limbs):
        weight = Decimal(2 ** (LIMB_BITS * (len(limbs) - 1 - k)))
        out = out + (limb.cast("decimal(19,0)") * F.lit(weight).cast("decimal(38,0)")).cast("decimal(38,0)")
    return out.cast("decimal(38,0)")


def total(prefix: str) -> Column:
    """The sum of a value from its aggregated limbs; null where all were null."""
    s = [F.col(f"{prefix}_{k}") for k in range(LIMBS)]
    limbs, carry = [], F.lit(0).cast("long")
    for k in range(LIMBS - 1, 0, -1):
        with_carry = s[k] + carry
        limbs.insert(0, with_carry.bitwiseAND(F.lit(_MASK).cast("long")))
        carry = F.shiftright(with_carry, LIMB_BITS)
    top = s[0] + carry
    # the low limbs of a large sum only decide the direction of rounding: one bit stands for them
    low = F.when((limbs[2] != 0) | (limbs[3] != 0), 1).otherwise(0).cast("long")
    small = F.abs(top) < 2 ** 29
    fine = _decimal([F.when(small, top).otherwise(0), *limbs]).cast("double") * 2.0 ** -72
    coarse = _decimal([top, limbs[0], limbs[1].bitwiseOR(low)]).cast("double") * 2.0 ** -24
    rest = F.col(f"{prefix}_rest")
    whole = F.when(small, fine).otherwise(coarse)
    return F.when(F.col(f"{prefix}_n") > 0, F.when(rest.isNull(), whole).otherwise(rest + whole))


def mean(prefix: str) -> Column:
    """The mean of a value from its aggregated limbs; null where all were null."""
    return F.try_divide(total(prefix), F.col(f"{prefix}_n").cast("double"))
