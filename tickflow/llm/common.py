"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

import tickflow
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import drop_scratch, scratch_path

# White space of the word contracts: space and the five ASCII controls.
WORD_SPACE = " \t\n\x0b\x0c\r"

# Id sets up to this many rows are broadcast (8 bytes a row: 32 MB); larger
# ones are joined by a shuffle.
BROADCAST_IDS_MAX = 4_000_000


def package_on_workers(spark: SparkSession) -> None:
    """Adds this package's folder to the Python path of the workers, for
    sessions whose workers do not start in it.  On a cluster where the package
    is installed or shipped with ``--py-files`` this changes nothing."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(tickflow.__file__)))
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if here not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (path, here) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back, so that
    later steps neither recompute it nor depend on a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Removes what :func:`stored` wrote for these frames, once nothing reads them any more."""
    for df in frames:
        drop_scratch(df.sparkSession, df._stored_at)


def id_text(docs: DataFrame, id_col: str):
    """The id column as text, for its way through pandas, which turns whole
    numbers beside nulls into doubles; ``id_back`` undoes it."""
    return docs[id_col].cast("string")


def id_back(df: DataFrame, name: str, docs: DataFrame, id_col: str) -> DataFrame:
    """``df`` with its text column ``name`` as the id column of ``docs``, first."""
    rest = [c for c in df.columns if c != name]
    return df.select(F.col(name).cast(docs.schema[id_col].dataType).alias(id_col), *rest)


def small_side(df: DataFrame, rows: int, max_rows: int = BROADCAST_IDS_MAX) -> DataFrame:
    """``df`` marked for broadcast if ``rows``, its counted size, is within the
    bound; unchanged beyond it (Spark then shuffles both sides)."""
    return F.broadcast(df) if rows <= max_rows else df


def words(text):
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text column (null: empty)."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", " " * 5)
    return F.array_remove(F.split(plain, " "), "")
