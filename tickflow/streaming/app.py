"""The streaming application: the three reference queries started together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickflow.streaming import queries as P


def start_all(prices: DataFrame, market: DataFrame, out_root: str, checkpoint_root: str,
              price_trigger: dict | None = None, market_trigger: dict | None = None,
              metrics_path: str | None = None, watermark: str | None = None,
              watermark_log: str | None = None) -> list[StreamingQuery]:
    """Starts raw prices (K1), the window log (K2) and market metrics (K3),
    each with its own checkpoint under ``checkpoint_root`` and sink under
    ``out_root``.  ``watermark`` bounds the window query's state; a
    ``watermark_log`` delay adds a second, append-mode window query (E4)
    writing ``windows_wm`` next to the update log."""
    qs = [
        P.start_raw_prices(prices, f"{out_root}/raw", f"{checkpoint_root}/raw", price_trigger, metrics_path),
        P.start_window_log(prices, f"{out_root}/windows", f"{checkpoint_root}/windows", price_trigger,
                           metrics_path, watermark=watermark),
    ]
    if watermark_log:
        qs.append(P.start_window_log(prices, f"{out_root}/windows_wm", f"{checkpoint_root}/windows_wm",
                                     price_trigger, metrics_path, watermark=watermark_log,
                                     name="price_windows_watermark"))
    qs.append(P.start_market_metrics(market, f"{out_root}/market", f"{checkpoint_root}/market",
                                     market_trigger, metrics_path))
    return qs


def run_all(spark: SparkSession, *args, timeout_s: float | None = None, **kw) -> list[StreamingQuery]:
    """``start_all`` then wait for every query; the first failure stops the
    others and is raised at once."""
    qs = start_all(*args, **kw)
    P.await_all(spark, qs, timeout_s)
    return qs
