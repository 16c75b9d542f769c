"""Equal shares of a table in the order of a key, without sorting the table.

Only the rows near a cut need an exact place; all others lie wholly in one
share.  The cuts are located by a mergeable sketch, the rows between two
bounds are counted exactly, and only the slices that a cut runs through are
numbered (by ``ordinal``).  The sketch decides how many rows that are, never
which share a row gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.operators.ordinal import ordinal

# Relative error of the sketch is one by this; smallest long, for NULL.
SKETCH_ACCURACY = 10_000
_LEAST = -(2 ** 63)


def _slice_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the key: 0 to len(bounds)."""
    out = F.lit(0)
    for b in bounds:
        out = out + (key >= F.lit(b).cast("long")).cast("int")
    return out


def _bounds(rows: DataFrame, key: Column, shares: int) -> list[int]:
    """Values of the key shortly before and after each cut, ascending."""
    near = 2 / SKETCH_ACCURACY
    at = sorted({min(1.0, max(0.0, k / shares + d)) for k in range(1, shares) for d in (-near, near)})
    if not at:
        return []
    found = rows.agg(F.percentile_approx(key, F.array(*[F.lit(p) for p in at]), F.lit(SKETCH_ACCURACY))).first()[0]
    return sorted(set(found or []))


def in_shares(rows: DataFrame, order_cols: list[str], total: int, shares: int, name: str) -> DataFrame:
    """Adds ``name``: the share (0-based, int) of each row when ``total`` rows are
    dealt in ascending order of ``order_cols`` (NULL first) to shares of
    ``ceil(total / shares)`` rows; rows that tie may change places.

    The first of ``order_cols`` must be of an integer type.  ``rows`` is
    scanned three times, twice of them for that column alone; what is shuffled is
    the rows of the slices that hold a cut, a few ten-thousandths of the
    table for each unless many rows share one key."""
    size = max(1, -(-total // shares))
    key = F.coalesce(F.col(order_cols[0]).cast("long"), F.lit(_LEAST).cast("long"))
    bounds = _bounds(rows, key, shares)
    at = _slice_of(key, bounds)
    counts = {r[0]: r[1] for r in rows.select(at.alias("s")).groupBy("s").count().collect()}  # one row a slice
    first, whole, cut = 0, {}, {}
    for s in range(len(bounds) + 1):
        n = counts.get(s, 0)
        if n and first // size != (first + n - 1) // size:
            cut[s] = first
        else:
            whole[s] = first // size
        first += n
    slice_, place = f"__{name}_slice", f"__{name}_place"
    rows_at = rows.withColumn(slice_, at)
    # slices without a cut: the share by slice, looked up in a literal array
    table = F.array(*[F.lit(whole.get(s)).cast("int") for s in range(len(bounds) + 1)])
    plain = rows_at.withColumn(name, F.element_at(table, F.col(slice_) + 1)).filter(F.col(name).isNotNull()).drop(slice_)
    if not cut:
        return plain
    start = F.create_map(*[F.lit(x).cast("long") for kv in cut.items() for x in kv])
    numbered = ordinal(rows_at.filter(F.col(slice_).isin(list(cut))), [slice_], order_cols, place)
    dealt = numbered.withColumn(
        name, F.floor((F.element_at(start, F.col(slice_).cast("long")) + F.col(place)) / size).cast("int"))
    return plain.unionByName(dealt.drop(slice_, place))
