"""Per-coin market analyses: average changes, tracked-coin filter, top by cap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions import exact
from tickflow.operators.windows import require_columns

# The coins the publisher tracks by default.
TRACKED_COINS = ["bitcoin", "ethereum", "binancecoin", "ripple", "cardano", "solana", "polkadot", "dogecoin"]

# Averaged columns and the names of their means.
CHANGES = {"price_change_24h": "avg_price_change", "market_cap_change_24h": "avg_market_cap_change",
           "volume_change_24h": "avg_volume_change"}

# Largest tracked-coin table that is broadcast for the semi join.
BROADCAST_MAX_ROWS = 100_000


def avg_changes(df: DataFrame) -> DataFrame:
    """Per coin: mean price, market-cap and volume change.  Partial aggregation
    runs before the shuffle, so a coin holding most rows costs one partial row
    per task, not a hot reducer.  Sums are exact, whatever the partitioning."""
    require_columns(df, "coin_id", *CHANGES)
    d = exact.split(df.select("coin_id", *CHANGES), **{c: F.col(c) for c in CHANGES})
    g = d.groupBy("coin_id").agg(*exact.sums(*CHANGES))
    return g.select("coin_id", *[exact.mean(c).alias(name) for c, name in CHANGES.items()])


def tracked(df: DataFrame, coins=None, key: str = "coin_id") -> DataFrame:
    """Keep rows of tracked coins.

    ``coins`` is a list (an ``IN`` filter pushed into the scan) or a DataFrame
    with a ``coin_id`` column (a left-semi join, broadcast only when the table
    is proven to hold at most ``BROADCAST_MAX_ROWS`` rows; otherwise Spark
    shuffles both sides)."""
    coins = TRACKED_COINS if coins is None else coins
    if not hasattr(coins, "columns"):
        return df.filter(F.col(key).isin(list(coins)))
    # the table's row count bounds its distinct ids: checked without a shuffle
    small = coins.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS
    ids = coins.select(F.col("coin_id").alias("_tracked")).distinct()
    side = F.broadcast(ids) if small else ids
    return df.join(side, F.col(key) == F.col("_tracked"), "left_semi")


def top_by_market_cap(df: DataFrame, n: int) -> DataFrame:
    """Largest market caps first, ties by coin_id (the API's market_cap_desc
    order with per_page = n).  Spark runs this as a per-partition top-n and a
    single merge of at most n rows per partition."""
    return df.orderBy(F.desc("market_cap"), F.asc("coin_id")).limit(n)


def coin_market_caps(df: DataFrame) -> DataFrame:
    """One ranking value per coin: its largest observed market cap."""
    return df.groupBy("coin_id").agg(F.max("market_cap").alias("market_cap"))
