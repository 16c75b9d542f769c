"""The registered queries of the operators, with production parameters, and
their DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm import (forest_search, jaccard_join, line_dedup, oracle, packing, periodic_runs, pieces, pii, quality_rules,
                          quotations, sharding, token_counts, toxicity, turn_repair)
from tickflow.llm.common import table


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file (installed on every worker)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of every document, and whether it is rejected."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses permuted."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.key_of(spark))


def op3_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotations, linked and in reply order."""
    return quotations.link_quotations(table(spark, sf_dir, "conversations"))


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 512 to 4096 words."""
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op5_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest of every vector whose id is divisible by 20."""
    return forest_search.forest_search(table(spark, sf_dir, "embeddings"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.line_first(table(spark, sf_dir, "documents")).drop("clean_text")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of equal row counts."""
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under byte_bpe_50k.json."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components under 85 percent similarity of 4-word shingles."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded text of every whole text, as digests."""
    return pieces.piece_round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the damage."""
    return turn_repair.repair_turns(table(spark, sf_dir, "conversations"), damage=True)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that an earlier one holds, as a digest."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some with a planted tail."""
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_pseudonyms, op3_quotations, op4_best_fit, op5_forest_search, op6_line_rules, op7_shards,
    op8_token_counts, op9_jaccard, op10_pieces, op11_turn_repair, op12_line_dedup, op13_periodic_runs)}

ORACLE: dict[str, str] = oracle.all_sql()
