"""A corpus in five stages: quality rules, near copies, benchmark leaks, mixing, sharding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from calltext.llm import decontamination, mixing, quality, sharding, simhash
from calltext.operators import staging


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive thresholds accept. A null or empty text has too
    few words for the rules; repeated rows are judged alike."""
    return quality.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, those with the least ids; documents without words are
    one group. Fingerprints of three-word shingles link at two or fewer differing bits."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows go together."""
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order. Null sources are a source, one
    without words is left out, repeated rows have places of their own."""
    return mixing.in_training_order(docs, mixing.curriculum(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Which shard and slot each row goes to. A null text has size 1; equal texts share a shard."""
    return sharding.shard_by_bytes(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("near copies", drop_near_copies),
    ("benchmark leaks", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]
# Fingerprints, components and tiling are no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again. The folder is
    removed when the last result is staged. An empty table gives no rows, and columns of any names
    are carried along to the last stage."""
    folder = f"{staging.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    result = staging.stage(STAGES[-1][1](spark, docs, sf_dir))
    staging.remove_folder(spark, folder)
    return result
