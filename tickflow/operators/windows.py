"""Sliding event-time window aggregation per coin (one definition for batch
and Structured Streaming).

Spark rewrites a sliding ``window`` into an Expand (one projection per window
a row falls in) followed by a partial and a final hash aggregate, so each
task pre-aggregates before the shuffle on (window, coin_id) and a hot coin
never lands whole in one task: its rows are spread over all its windows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions import exact

# Window length and slide of the analysis.
WINDOW_DURATION = "15 minutes"
SLIDE_DURATION = "5 minutes"

WINDOW_KEYS = ["window_start", "window_end", "coin_id"]
WINDOW_VALUES = ["avg_price", "min_price", "max_price", "total_volume"]


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Schema guard: fail at plan time when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; have {df.columns}")
    return df


def window_aggregates(df: DataFrame, time_col: str = "timestamp", key: str = "coin_id",
                      price: str = "price_usd", volume: str = "volume_24h",
                      duration: str = WINDOW_DURATION, slide: str = SLIDE_DURATION,
                      extra: list | None = None) -> DataFrame:
    """avg/min/max of price and sum of volume per (sliding window, key).

    Returns the window struct as ``window``; use :func:`flatten_window` for the
    stored form.  Rows with a NULL time fall in no window.  ``extra`` adds more
    aggregate columns (e.g. a row count).
    """
    require_columns(df, time_col, key, price, volume)
    aggs = [F.avg(price).alias("avg_price"), F.min(price).alias("min_price"),
            F.max(price).alias("max_price"), F.sum(volume).alias("total_volume")]
    return df.groupBy(F.window(time_col, duration, slide).alias("window"), F.col(key).alias("coin_id")) \
             .agg(*aggs, *(extra or []))


def flatten_window(df: DataFrame, window_col: str = "window") -> DataFrame:
    """``window{start,end}`` to ``window_start``, ``window_end`` columns first."""
    rest = [c for c in df.columns if c != window_col]
    return df.select(F.col(f"{window_col}.start").alias("window_start"),
                     F.col(f"{window_col}.end").alias("window_end"), *rest)


def windowed(df: DataFrame, time_col: str = "timestamp", key: str = "coin_id",
             price: str = "price_usd", volume: str = "volume_24h",
             duration: str = WINDOW_DURATION, slide: str = SLIDE_DURATION, extra: list | None = None) -> DataFrame:
    """The stored form: window_start, window_end, coin_id, avg/min/max_price, total_volume.

    The batch form of :func:`window_aggregates`: grouped by the flat bounds, so
    that a join on them reuses the grouping's partitioning."""
    require_columns(df, time_col, key, price, volume)
    w = df.select(F.window(time_col, duration, slide).alias("w"), F.col(key).alias("coin_id"),
                  F.col(price).alias("p"), F.col(volume).alias("v"))
    return (w.groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "coin_id")
            .agg(F.avg("p").alias("avg_price"), F.min("p").alias("min_price"),
                 F.max("p").alias("max_price"), F.sum("v").alias("total_volume"), *(extra or [])))


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(interval: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", interval.lower())
    if not m:
        raise ValueError(f"not a number of seconds, minutes, hours or days: {interval!r}")
    return int(m[1]) * _SECONDS[m[2]]


def pane_windowed(df: DataFrame, time_col: str = "timestamp", key: str = "coin_id",
                  price: str = "price_usd", volume: str = "volume_24h",
                  duration: str = WINDOW_DURATION, slide: str = SLIDE_DURATION) -> DataFrame:
    """The stored form, by panes: rows are aggregated once per (slide-long
    pane, key), and the panes, not the rows, are merged into the windows that
    hold them.  The sums are exact (``functions.exact``), so the result does
    not depend on how the rows are partitioned.

    ``duration`` must be a multiple of ``slide``.  A pane that holds most rows
    is pre-aggregated in every task before the shuffle."""
    require_columns(df, time_col, key, price, volume)
    if _seconds(duration) % _seconds(slide):
        raise ValueError(f"{duration} is not a multiple of {slide}")
    rows = df.select(F.window(time_col, slide)["start"].alias("pane"), F.col(key).alias("coin_id"),
                     F.col(price).alias("p"), F.col(volume).alias("v"))
    spread = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), *exact.sums("p", "v")]
    rows = exact.split(rows, p=F.col("p"), v=F.col("v")).withColumns({"lo": F.col("p"), "hi": F.col("p")})
    panes = rows.groupBy("pane", "coin_id").agg(*spread)
    w = panes.withColumn("w", F.window("pane", duration, slide))
    merged = w.groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "coin_id").agg(*spread)
    return merged.select(*WINDOW_KEYS, exact.mean("p").alias("avg_price"), F.col("lo").alias("min_price"),
                         F.col("hi").alias("max_price"), exact.total("v").alias("total_volume"))


def null_time_count(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows a window aggregate drops because their event time is NULL."""
    return df.agg(F.count(F.when(F.col(time_col).isNull(), 1)).alias("null_time_rows"))
