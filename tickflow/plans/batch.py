"""Batch queries over the driver tables: one function per registered query,
each ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.arith import round_double
from tickflow.operators import windows as W
from tickflow.plans import fixtures as X


def _rounded(df: DataFrame, cols, scale: int = 6) -> DataFrame:
    return df.withColumns({c: round_double(F.col(c), scale) for c in cols})


def price_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + P3: sliding 15/5 minute window aggregate per coin over stored prices."""
    return W.pane_windowed(X.prices(spark, sf_dir))


def _event_id_from_key() -> F.Column:
    return F.col("key").cast("string").cast("long").alias("event_id")


def decode_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2: decoded price messages that parse (rejects split off)."""
    from tickflow.functions import messages as M
    from tickflow.schemas import PRICE_MESSAGE
    d = M.decode(X.price_messages(spark, sf_dir), PRICE_MESSAGE, with_corrupt=True)
    ok, _ = M.split_rejects(d)
    return ok.select(_event_id_from_key(), "coin_id", "price_usd",
                     round_double(F.col("market_cap")).alias("market_cap"), "volume_24h", "timestamp")


def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that do not decode, with their raw text."""
    from tickflow.functions import messages as M
    from tickflow.schemas import CORRUPT_COL, PRICE_MESSAGE
    d = M.decode(X.price_messages(spark, sf_dir), PRICE_MESSAGE, with_corrupt=True)
    _, bad = M.split_rejects(d)
    return bad.select(_event_id_from_key(), F.col(CORRUPT_COL).alias("raw"))


def decode_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 on market messages."""
    from tickflow.functions import messages as M
    from tickflow.schemas import MARKET_MESSAGE
    d = M.decode(X.market_messages(spark, sf_dir), MARKET_MESSAGE)
    return d.select(F.col("key").cast("string").alias("message_key"), "coin_id", "price_change_24h",
                    "market_cap_change_24h", "volume_change_24h", "timestamp")


def encode_price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + F8: price rows as JSON messages (key, topic, value text)."""
    from tickflow.functions import messages as M
    e = M.encode(X.prices(spark, sf_dir), X.PRICE_FIELDS, key=F.col("event_id"), topic="prices")
    return e.select(F.col("key").cast("string").cast("long").alias("event_id"), "topic",
                    F.col("value").cast("string").alias("value"))


def market_avg_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: mean changes per coin over stored market rows."""
    from tickflow.operators.market import avg_changes
    return avg_changes(X.market_rows(spark, sf_dir))


# The coins the fixture tracks (event types standing in for coin ids).
FIXTURE_TRACKED = ["click", "purchase", "view"]


def tracked_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows of tracked coins only (IN filter pushed to the scan)."""
    from tickflow.operators.market import tracked
    t = tracked(X.prices(spark, sf_dir), FIXTURE_TRACKED)
    return t.select("event_id", "coin_id", "price_usd", round_double(F.col("market_cap")).alias("market_cap"),
                    "volume_24h", "timestamp")


def tracked_coins_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, table form: price rows of the coins in a tracked-coin table."""
    from tickflow.operators.market import tracked
    t = tracked(X.prices(spark, sf_dir), X.tracked_coin_table(spark, sf_dir))
    return t.select("event_id", "coin_id", "price_usd", "volume_24h", "timestamp")


TOP_N = 3


def top_market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The TOP_N coins by market cap, descending, ties by coin_id."""
    from tickflow.operators.market import coin_market_caps, top_by_market_cap
    t = top_by_market_cap(coin_market_caps(X.prices(spark, sf_dir)), TOP_N)
    return t.select("coin_id", round_double(F.col("market_cap")).alias("market_cap"))


def flatten_simple_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 + F9: object-keyed payloads to price rows."""
    from tickflow.functions.messages import flatten_simple_price as flat
    return flat(X.simple_price_payloads(spark, sf_dir), keep=("event_id",))


def flatten_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array payloads to market rows."""
    from tickflow.functions.messages import flatten_markets as flat
    return flat(X.markets_payloads(spark, sf_dir), keep=("l_orderkey",))


def flatten_simple_price_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: entries without a price, and payloads that do not parse."""
    from tickflow.functions.messages import simple_price_rejects
    p = X.broken_payloads(X.simple_price_payloads(spark, sf_dir), "event_id")
    return simple_price_rejects(p, keep=("event_id",))


def flatten_markets_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market payloads that do not parse."""
    from tickflow.functions.messages import markets_rejects
    p = X.broken_payloads(X.markets_payloads(spark, sf_dir), "l_orderkey")
    return markets_rejects(p, keep=("l_orderkey", "l_linenumber"))


def metrics_nested_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics documents that do not parse."""
    from tickflow.operators.metrics import nested_rejects
    docs = X.nested_metrics_documents(spark, sf_dir).withColumnRenamed("document", "payload")
    broken = X.broken_payloads(docs, "doc_id").withColumnRenamed("payload", "document")
    return nested_rejects(broken, keep=("doc_id",))


def sink_typed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: price rows in their stored DECIMAL types (shown as double)."""
    from tickflow.operators.typed_sink import to_sink_types
    from tickflow.schemas import PRICE_SINK_DECIMALS
    t = to_sink_types(X.prices(spark, sf_dir), PRICE_SINK_DECIMALS)
    return t.select("event_id", "coin_id", *[F.col(c).cast("double").alias(c) for c in PRICE_SINK_DECIMALS],
                    "timestamp", "is_reject")


def sink_overflow_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: rows with values beyond their DECIMAL type are kept as rejects."""
    from tickflow.operators.typed_sink import to_sink_types
    from tickflow.schemas import PRICE_SINK_DECIMALS
    t = to_sink_types(X.overflowing_prices(spark, sf_dir), PRICE_SINK_DECIMALS)
    return t.select("event_id", "coin_id", *[F.col(c).cast("double").alias(c) for c in PRICE_SINK_DECIMALS], "is_reject")


def price_windows_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by the time rows arrived instead of their event time."""
    from tickflow.functions.timecols import arrival_time
    p = X.prices_by_arrival(spark, sf_dir).withColumn("arrived", arrival_time())
    return W.pane_windowed(p, time_col="arrived")


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + F7: report per processing mode over the metrics log."""
    from tickflow.operators.metrics import report
    r = report(X.metrics_records(spark, sf_dir))
    return _rounded(r, ["avg_latency", "avg_throughput", "avg_cpu_usage", "avg_memory_usage"])


def metrics_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2: per-mode plot series by record number."""
    from tickflow.operators.metrics import series
    s = series(X.metrics_records(spark, sf_dir))
    return _rounded(s, ["latency", "throughput", "cpu_percent", "memory_percent"])


def metrics_series_null_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 where every fifth record has no mode: they are a group like any other."""
    from tickflow.operators.metrics import series
    m = X.metrics_records(spark, sf_dir).withColumn("mode", F.when(F.col("seq") % 5 != 0, F.col("mode")))
    return _rounded(series(m), ["latency", "throughput", "cpu_percent", "memory_percent"])


def metrics_nested_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested metrics documents to flat records."""
    from tickflow.operators.metrics import import_nested
    f = import_nested(X.nested_metrics_documents(spark, sf_dir), keep=("doc_id",))
    return _rounded(f, ["processing_time", "throughput", "cpu_percent", "memory_percent", "memory_used_gb"])


def trending_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 coins by mean price change."""
    from tickflow.operators.extensions import trending
    return trending(market_avg_changes(spark, sf_dir), 3)


def volume_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coins ranked by total volume inside each window."""
    from tickflow.operators.extensions import volume_rank as vr
    return vr(W.pane_windowed(X.prices(spark, sf_dir)))


def market_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of each coin's window average from its previous window."""
    from tickflow.operators.extensions import market_trend as mt
    return mt(W.pane_windowed(X.prices(spark, sf_dir)))
