"""Registry of the queries the driver runs and their oracle SQL."""

from __future__ import annotations

from tickflow.plans import batch, streams
from tickflow.plans import oracle as sql_oracle

QUERIES = {
    name: getattr(batch, name) for name in (
        "price_window_agg", "decode_prices", "decode_rejects", "decode_market", "encode_price_messages",
        "market_avg_changes", "tracked_coins", "top_market_cap", "flatten_simple_price", "flatten_markets",
        "flatten_simple_price_rejects", "flatten_markets_rejects", "metrics_nested_rejects", "metrics_series_null_mode",
        "sink_typed_prices", "metrics_report", "metrics_series", "metrics_nested_import",
        "trending_coins", "volume_rank", "market_trend", "tracked_coins_table",
        "sink_overflow_prices", "price_windows_by_arrival")
}
QUERIES.update({
    name: getattr(streams, name) for name in (
        "stream_raw_prices", "stream_rejects", "stream_market_metrics", "stream_price_windows_log",
        "stream_price_windows_latest", "stream_price_windows_watermark", "compare_stream_batch_log",
        "compare_stream_batch_latest", "consistency_summary", "stream_metrics", "batch_metrics",
        "compare_stored_log", "compare_stored_latest", "consistency_stored", "stream_price_windows_live",
        "stream_metrics_watermark", "stream_price_windows_latest_compacted", "stream_progress", "stream_late_windows",
        "stream_late_dropped", "stream_late_kept", "stream_tracked", "stream_open_windows", "stream_raw_prices_capped",
        "stream_price_windows_capped", "compare_bucketed", "batch_report", "batch_consistency", "batch_metrics_failed")
})


def oracle() -> dict[str, str]:
    sql = sql_oracle.all_sql()
    return {k: v for k, v in sql.items() if k in QUERIES}
