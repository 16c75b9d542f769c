"""A training corpus from raw documents: toxic documents go, lines that break
the quality rules go and so do documents that lose too much, one document of
each group of near copies stays, personal values become pseudonyms, and what
is left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import jaccard_join, packing, pii, quality_rules, toxicity
from tickflow.llm.common import package_on_workers, stored, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    package_on_workers(spark)
    return toxicity.without_toxic(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failing lines."""
    return quality_rules.clean_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group under 80 percent similarity of 5-word shingles."""
    package_on_workers(spark)
    return jaccard_join.one_of_each(docs, n=5, percent=80, null_ids_apart=False)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with format-preserving pseudonyms."""
    return pii.masked_documents(docs, pii.key_of(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in the training sequences."""
    package_on_workers(spark)
    return packing.best_fit(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("quality_rules", clean_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", mask_personal),
    ("best_fit_packing", pack_sequences),
]

# A trained classifier and packing have no SQL form; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as
    Parquet in the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
