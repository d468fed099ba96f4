"""The operators as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltext.llm import (
    classifier, decontamination, extraction, lines, merkle, mixing, privacy, quality, sharding,
    simhash, spelling, substrings, urls,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_segmented_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with its verdict."""
    return urls.judged(_table(spark, folder, "pages"))


def op2_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the chunks of lines that stand elsewhere before."""
    return lines.without_repeated_chunks(_table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_super_kmer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that earlier documents hold."""
    return substrings.without_repeats(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_benchmark_tiling(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of its words they cover."""
    found = decontamination.contaminated(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "item_id", "item_words", "covered", F.size("tiles").cast("long").alias("n_tiles"))


def op5_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with how many of its words the mix takes and where in training it stands."""
    plan = mixing.in_place(mixing.curriculum(_table(spark, folder, "documents")))
    return plan.select(
        F.col("_key").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("passes")).alias("taken"),
        *(F.round(c, 9).alias(c) for c in ("first_position", "last_position")), "first_rank")


def op6_simhash_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint and the least document of its component."""
    return simhash.near_components(_table(spark, folder, "documents")).select(
        "doc_id", F.col("print").alias("fingerprint"), F.col("first").alias("component_id"))


def op7_disclosing_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal data and the terms that disclose it."""
    found = privacy.sensitive_spans(_table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(privacy.KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long")
              for i, k in enumerate(privacy.KINDS)}
    return found.select(
        F.col("_key").alias("doc_id"), *(c.alias(n) for n, c in counts.items()),
        F.sha2(privacy.as_text(base), 256).alias("base_sha256"),
        privacy.as_text(F.col("spans")).alias("spans"))


def op8_adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its measures and verdict."""
    return quality.judged(_table(spark, folder, "documents")).select(
        F.col("_key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def op9_cotrained_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its quality by both views and together."""
    return classifier.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its shard and slot."""
    return sharding.shard_by_bytes(_table(spark, folder, "documents"))


def op11_merkle_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its proof and the root that its version has."""
    tree = merkle.Manifest(merkle.tampered(_table(spark, folder, "documents")))
    return tree.proofs().select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_recurrent_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with its main text."""
    pages = _table(spark, folder, "pages")
    return extraction.main_texts(pages, extraction.fitted(pages), "html", "page_id", "url")


def op13_bit_sliced_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word with the form that it is a variant of."""
    return spelling.variants(spelling.words(_table(spark, folder, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_segmented_hosts, op2_line_chunks, op3_super_kmer_dedup, op4_benchmark_tiling, op5_curriculum_mix,
    op6_simhash_planes, op7_disclosing_terms, op8_adaptive_quality,
    op9_cotrained_quality, op10_minimax_shards, op11_merkle_versions,
    op12_recurrent_blocks, op13_bit_sliced_variants)}
