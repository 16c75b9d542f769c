"""Processing metrics: per-mode report, plot series, nested-log import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.arith import throughput
from tickflow.operators.ordinal import ordinal
from tickflow.schemas import METRICS_RECORD, MODES, NESTED_MODE


def load_metrics(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame:
    """The flat metrics log at ``path``; an empty log with the schema when the
    path is None or holds no table yet."""
    if path:
        try:
            return spark.read.format(fmt).schema(METRICS_RECORD).load(path)
        except Exception as e:  # only a missing table means "no metrics yet"
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in METRICS_RECORD.fields])


def report(metrics: DataFrame) -> DataFrame:
    """Per mode: mean latency, mean throughput, total errors, mean CPU and
    memory; both modes are always present, with 0 when a mode has no record."""
    spark = metrics.sparkSession
    agg = metrics.groupBy("mode").agg(
        F.avg("processing_time").alias("avg_latency"),
        F.avg(throughput(F.col("rows"), F.col("processing_time"))).alias("avg_throughput"),
        F.sum("error_count").alias("total_errors"),
        F.avg("cpu_percent").alias("avg_cpu_usage"),
        F.avg("memory_percent").alias("avg_memory_usage"),
    )
    # two fixed rows, built JVM-side; broadcasting them is bounded by construction
    modes = F.broadcast(spark.range(1).select(F.explode(F.array(*[F.lit(m) for m in MODES])).alias("mode")))
    out = agg.join(modes, "mode", "right")
    return out.select("mode",
                      *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                        for c in ("avg_latency", "avg_throughput")],
                      F.coalesce(F.col("total_errors"), F.lit(0)).cast("long").alias("total_errors"),
                      *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                        for c in ("avg_cpu_usage", "avg_memory_usage")])


def _parsed(docs: DataFrame, doc_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Each document parsed once, as a VARIANT ``v``: NULL where it is no JSON."""
    return docs.select(*keep, F.col(doc_col).alias("raw"),
                       F.inline(F.array(F.struct(F.try_parse_json(F.col(doc_col)).alias("v")))))


def nested_rejects(docs: DataFrame, doc_col: str = "document", keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents that :func:`import_nested` gives no record for because they
    are no JSON object (or are NULL)."""
    kind = F.coalesce(F.schema_of_variant("v"), F.lit(""))
    return _parsed(docs, doc_col, keep).filter(~kind.startswith("OBJECT")).select(*keep, "raw")


SERIES_ORDER = ["seq", "latency", "throughput", "cpu_percent", "memory_percent"]


def series(metrics: DataFrame) -> DataFrame:
    """Plot input: per mode, record number (0-based, by seq), latency,
    throughput, CPU and memory.  Records with equal seq are ordered by their
    content, so tied records that get swapped are identical."""
    s = metrics.select("mode", "seq", F.col("processing_time").alias("latency"),
                       throughput(F.col("rows"), F.col("processing_time")).alias("throughput"),
                       "cpu_percent", "memory_percent")
    return ordinal(s, ["mode"], SERIES_ORDER, name="idx").drop("seq")


# The parallel lists of a mode and the types their entries are read as; of a data point only
# what a record takes is cast, each number of which costs as much as parsing it.
NESTED_LISTS = ({f.name: f.dataType.simpleString() for f in NESTED_MODE.fields}
                | {"data_points": "array<struct<batch_size:double,total_records:double>>"})


def import_nested(docs: DataFrame, doc_col: str = "document", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested metrics documents (mode -> parallel lists) to flat records, one
    per list position; works per document, so any number of documents.

    A document is parsed once, to a VARIANT that is exploded by mode.  Lists of
    unequal length give a record for every position of the longest, NULL where a list
    has ended; a list that is missing or has an entry of another type counts as
    empty."""
    spark = docs.sparkSession
    m = _parsed(docs, doc_col, keep).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    m = m.filter(F.col("key").isNotNull())  # elements of a list have none
    lists = [F.coalesce(F.try_variant_get("value", f"$.{n}", t), F.array().cast(t)).alias(n) for n, t in NESTED_LISTS.items()]
    z = m.select(*keep, F.col("key").alias("mode"), F.posexplode(F.arrays_zip(*lists)).alias("pos", "_r"))
    return z.select(
        *keep, "mode", F.col("pos").cast("long").alias("pos"),
        F.coalesce(F.col("_r.data_points.batch_size"), F.col("_r.data_points.total_records")).alias("rows"),
        F.col("_r.latency").alias("processing_time"),
        F.col("_r.throughput").alias("throughput"),
        F.col("_r.errors").alias("error_count"),
        F.col("_r.resource_usage.cpu_percent").alias("cpu_percent"),
        F.col("_r.resource_usage.memory_percent").alias("memory_percent"),
        F.col("_r.resource_usage.memory_used_gb").alias("memory_used_gb"),
    )
