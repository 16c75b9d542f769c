"""Typed sink projection: doubles to the stored DECIMAL(p, s) columns.

Half-up rounding to the scale; a value that does not fit the precision is
not an error of the whole batch but a rejected row (``try_cast`` gives NULL
where the source was not NULL)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_sink_types(df: DataFrame, decimals: dict[str, tuple[int, int]],
                  flag: str = "is_reject") -> DataFrame:
    """Casts each listed column to its DECIMAL(p,s); ``flag`` marks rows where a
    non-NULL value overflowed."""
    cast = {c: F.col(c).try_cast(f"decimal({p},{s})") for c, (p, s) in decimals.items()}
    bad = F.lit(False)
    for c, v in cast.items():
        bad = bad | (F.col(c).isNotNull() & v.isNull())
    return df.withColumn(flag, bad).withColumns(cast)
