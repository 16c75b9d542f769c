"""Fixed schemas of messages, stored tables and the metrics log."""

from __future__ import annotations

from pyspark.sql import types as T

# Decoded price message (JSON fields; timestamp is epoch milliseconds).
PRICE_MESSAGE = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("price_usd", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("volume_24h", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

# Decoded market message.  volume_change_24h carries the absolute 24 h
# volume, not a change: the publisher fills it with the total volume.
MARKET_MESSAGE = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("price_change_24h", T.DoubleType()),
    T.StructField("market_cap_change_24h", T.DoubleType()),
    T.StructField("volume_change_24h", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

# Message envelope as a broker delivers it (the columns of the Kafka source
# that the streaming queries use).  File stand-ins of the broker use the same columns.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
])

CORRUPT_COL = "_corrupt_record"

# Stored column types of the three sink tables (precision, scale).
# They are the table definitions the results are stored under.
PRICE_SINK_DECIMALS = {"price_usd": (30, 8), "market_cap": (30, 2), "volume_24h": (30, 2)}
MARKET_SINK_DECIMALS = {"price_change_24h": (20, 8), "market_cap_change_24h": (20, 8),
                        "volume_change_24h": (20, 8)}
WINDOW_SINK_DECIMALS = {"avg_price": (20, 8), "min_price": (20, 8), "max_price": (20, 8),
                        "total_volume": (20, 2)}



def _stored(first, decimals, last):
    return T.StructType([T.StructField(n, t) for n, t in first]
                        + [T.StructField(c, T.DecimalType(*d)) for c, d in decimals.items()]
                        + [T.StructField(n, t) for n, t in last])


# What the three sinks write, with their partition columns.
_ROW_END = [("timestamp", T.TimestampNTZType()), (CORRUPT_COL, T.StringType()), ("is_reject", T.BooleanType()),
            ("ingest_ms", T.LongType()), ("batch_id", T.LongType()), ("event_date", T.DateType())]
RAW_PRICES_TABLE = _stored([("key", T.BinaryType()), ("coin_id", T.StringType())], PRICE_SINK_DECIMALS, _ROW_END)
MARKET_TABLE = _stored([("key", T.BinaryType()), ("coin_id", T.StringType())], MARKET_SINK_DECIMALS, _ROW_END)
WINDOWS_TABLE = _stored([("window_start", T.TimestampNTZType()), ("window_end", T.TimestampNTZType()),
                         ("coin_id", T.StringType())], WINDOW_SINK_DECIMALS,
                        [("is_reject", T.BooleanType()), ("batch_id", T.LongType())])

# One row per run (batch) or micro-batch (streaming).
METRICS_RECORD = T.StructType([
    T.StructField("mode", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows", T.DoubleType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("cpu_percent", T.DoubleType()),
    T.StructField("memory_percent", T.DoubleType()),
    T.StructField("memory_used_gb", T.DoubleType()),
])

# Nested metrics document: mode -> parallel lists.
_RESOURCE = T.StructType([
    T.StructField("cpu_percent", T.DoubleType()),
    T.StructField("memory_percent", T.DoubleType()),
    T.StructField("memory_used_gb", T.DoubleType()),
])
_POINT = T.StructType([
    T.StructField("batch_size", T.DoubleType()),
    T.StructField("total_records", T.DoubleType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("error_count", T.LongType()),
])
NESTED_MODE = T.StructType([
    T.StructField("latency", T.ArrayType(T.DoubleType())),
    T.StructField("throughput", T.ArrayType(T.DoubleType())),
    T.StructField("errors", T.ArrayType(T.LongType())),
    T.StructField("resource_usage", T.ArrayType(_RESOURCE)),
    T.StructField("data_points", T.ArrayType(_POINT)),
])
NESTED_METRICS = T.MapType(T.StringType(), NESTED_MODE)

MODES = ("streaming", "batch")

# The fields of a streaming query's progress that the progress log is read by
# (names as the engine writes them).
PROGRESS_ENTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("runId", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("durationMs", T.StructType([T.StructField("triggerExecution", T.LongType())])),
    T.StructField("eventTime", T.StructType([T.StructField("watermark", T.StringType())])),
    T.StructField("stateOperators", T.ArrayType(T.StructType([
        T.StructField("numRowsTotal", T.LongType()), T.StructField("numRowsUpdated", T.LongType()),
        T.StructField("numRowsDroppedByWatermark", T.LongType())]))),
])
