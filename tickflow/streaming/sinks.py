"""Micro-batch sinks for ``foreachBatch``.

Each batch is written by ONE DataFrame write (partition-parallel, no
collect).  File sinks are partitioned by ``batch_id`` and overwrite only that
partition (dynamic partition overwrite), so a batch that is replayed after a
failure replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow.schemas import METRICS_RECORD


def write_batch_partition(df: DataFrame, batch_id: int, path: str, fmt: str = "parquet",
                          partition_by: tuple[str, ...] = ()) -> None:
    """Idempotent write of one micro-batch under ``batch_id=<id>``.

    With ``partition_by`` rows of one partition are brought together first, so
    that a micro-batch writes a file per partition, not one per partition and
    task; adaptive execution splits a partition that is large."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
       .write.format(fmt).mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id", *partition_by)
       .save(path))


def read_sink(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a sink has written under ``path``, in its declared ``schema``; an
    empty frame where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], schema)


def store_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Writes ``df`` as a catalog table bucketed and sorted by ``keys`` (data
    under ``path``) and reads it back.  Tables of equal keys and buckets join on
    the keys without a shuffle; the rows are dealt to buckets once, here, with one
    file a bucket.  Choose ``buckets`` from the size of the larger table."""
    spark = df.sparkSession
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).mode("overwrite").format("parquet").saveAsTable(table))
    return spark.table(table)


def publish(messages: DataFrame, fmt: str = "kafka", **options) -> None:
    """Writes message envelopes (key, value, topic): to a broker with the
    connector's options, or to any file format that stands in for it."""
    messages.select("key", "value", "topic").write.format(fmt).mode("append") \
        .options(**{k: str(v) for k, v in options.items()}).save()


def write_jdbc(df: DataFrame, batch_id: int, url: str, table: str, **options) -> None:
    """Append a micro-batch to a JDBC table with its ``batch_id``.  A replayed
    batch appends again (at-least-once) unless the table is keyed on batch_id."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
       .write.format("jdbc").mode("append")
       .options(url=url, dbtable=table, **{k: str(v) for k, v in options.items()})
       .save())


class MeteredSink:
    """``foreachBatch`` callable: prepare the batch, write it once, record a
    metrics row (rows, seconds, rejected rows) for it.

    Row and reject counts are observed during the write itself, so the batch
    is not executed a second time to count it.  The metrics row goes to
    ``metrics_path`` partitioned by (query, batch_id), also idempotently.
    """

    def __init__(self, query: str, prepare: Callable[[DataFrame], DataFrame],
                 write: Callable[[DataFrame, int], None], metrics_path: str | None = None,
                 reject_col: str | None = None):
        self.query, self.prepare, self.write = query, prepare, write
        self.metrics_path, self.reject_col = metrics_path, reject_col

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        t0 = time.time()
        out = self.prepare(batch_df)
        obs = Observation(f"{self.query}_{batch_id}")
        rejects = F.count(F.when(F.col(self.reject_col), 1)) if self.reject_col else F.lit(0)
        out = out.observe(obs, F.count(F.lit(1)).alias("rows"), rejects.alias("rejects"))
        self.write(out, batch_id)
        seconds = time.time() - t0
        if self.metrics_path:
            m = obs.get
            spark = batch_df.sparkSession
            row = ("streaming", int(batch_id), self.query, int(batch_id), float(m["rows"]), seconds,
                   int(m["rejects"]), None, None, None)
            # one literal row built JVM-side (no Python worker per batch)
            rec = spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name)
                                          for v, f in zip(row, METRICS_RECORD.fields)])
            (rec.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("query", "batch_id").parquet(self.metrics_path))
