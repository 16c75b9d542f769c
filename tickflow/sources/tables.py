"""Batch sources: stored tables by format and options (parquet, jdbc, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
               schema=None, **options) -> DataFrame:
    """Generic batch scan.  For ``jdbc`` pass ``url``, ``dbtable`` and, for a
    parallel read, ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions``; without them a JDBC table is read by a single task."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    r = r.options(**{k: str(v) for k, v in options.items()})
    return r.load(path) if path is not None else r.load()


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 partitions: int | None = None, **extra) -> dict:
    """Options for a JDBC scan; credentials come from the caller."""
    o = {"url": url, "dbtable": table, **extra}
    if partition_column:
        o.update(partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                 numPartitions=partitions)
    return o


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the session has cores, for
    narrow rows from which much work follows; a table of enough files or
    splits is left alone, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
