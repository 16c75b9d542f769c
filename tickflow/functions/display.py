"""Display helpers (K6, F11).  Library functions return DataFrames; showing
them is the caller's action, done here without collecting more than ``n`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_places(c) -> Column:
    """``%.2f`` text of a number, as the log lines print prices and volumes."""
    return F.format_string("%.2f", F.col(c) if isinstance(c, str) else c)


def formatted(df: DataFrame, cols: list[str]) -> DataFrame:
    """The same rows with ``cols`` rendered as two-decimal text."""
    return df.withColumns({c: two_places(c) for c in cols})


def show_results(df: DataFrame, n: int = 20) -> None:
    """First ``n`` rows, untruncated (only those rows reach the driver)."""
    df.show(n, truncate=False)
