"""Streaming message sources.

``fmt="kafka"`` reads a topic (needs the Kafka connector on the classpath;
the message ``value`` column is the same).  Any file format stands in for
the broker with the same envelope columns (key, value, topic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.schemas import ENVELOPE


def kafka_options(bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None,
                  starting_offsets: str = "earliest", fail_on_data_loss: bool = False, **extra) -> dict:
    """Options of the Kafka source as the price and market streams use them."""
    o = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
         "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower(), **extra}
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return o


def message_stream(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                   max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming DataFrame of message envelopes with a BINARY ``value``."""
    r = spark.readStream.format(fmt)
    if fmt != "kafka":
        r = r.schema(ENVELOPE)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    r = r.options(**{k: str(v) for k, v in options.items()})
    try:
        df = r.load(path) if path is not None else r.load()
    except Exception as e:
        if fmt == "kafka" and "kafka" in str(e).lower() and "find" in str(e).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath "
                               "(spark.jars.packages); any file format with key/value/topic columns "
                               "can stand in for it") from e
        raise
    return df.select("key", "value", "topic") if fmt == "kafka" else df
