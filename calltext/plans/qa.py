"""Questions and answers: an analyst passage after a non-analyst one opens a new exchange.

The exchange number is a running count along the call. It is counted in blocks of passages and the
blocks are then put in order, so a very long call is not one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calltext.operators.staging import stage

BLOCK_LENGTH = 4096


def qa_passages(
    passages: DataFrame, key: Sequence[str] = ("file_name", "last_update"),
    order: str = "speaker_number", role: str = "role", analyst: str = "Analyst",
    block_length: int = BLOCK_LENGTH,
) -> DataFrame:
    """``key, order, qa_id, is_question``, without the passages before the first question.

    ``order`` is a whole number, unique within the key.
    """
    key = list(key)
    block = [*key, "__block"]
    rows = passages.select(
        *key, order, F.coalesce(F.col(role).rlike(analyst), F.lit(False)).alias("is_question"),
        F.floor(F.col(order) / block_length).alias("__block"),
    )
    within = Window.partitionBy(*block).orderBy(order)
    opens = F.col("is_question") & ~F.lag("is_question", 1, False).over(within)
    rows = rows.withColumn("__opens", opens.cast("int"))
    # Keys, numbers and flags only; the blocks are summed from them and joined with them.
    rows = stage(rows.withColumn("__count", F.sum("__opens").over(within)))
    ends = rows.groupBy(*block).agg(
        F.sum("__opens").alias("__total"),
        F.min_by("is_question", order).alias("__starts_with_question"),
        F.max_by("is_question", order).alias("__ends_with_question"),
    )
    # A block that starts with a question after one that ends with one goes on with its exchange.
    before = Window.partitionBy(*key).orderBy("__block")
    continued = (
        F.col("__starts_with_question")
        & F.lag("__ends_with_question", 1, False).over(before)
    ).cast("int")
    ends = ends.withColumn("__continued", continued)
    ends = ends.withColumn(
        "__offset", F.sum(F.col("__total") - F.col("__continued")).over(
            before.rowsBetween(Window.unboundedPreceding, -1)))
    offsets = ends.select(*block, (F.coalesce("__offset", F.lit(0)) - F.col("__continued")).alias(
        "__offset"))
    return (
        rows.join(offsets, block)
        .withColumn("qa_id", F.col("__count") + F.col("__offset"))
        .filter(F.col("qa_id") > 0)
        .select(*key, order, "qa_id", "is_question")
    )


def qa_pairs(
    passages: DataFrame, key: Sequence[str] = ("file_name", "last_update"),
    order: str = "speaker_number", role: str = "role", analyst: str = "Analyst",
    block_length: int = BLOCK_LENGTH,
) -> DataFrame:
    """One row per exchange: number, first and last passage of its questions and of its answers."""
    rows = qa_passages(passages, key, order, role, analyst, block_length)
    asked, answered = F.col("is_question"), ~F.col("is_question")
    return rows.groupBy(*key, "qa_id").agg(
        F.count(F.when(asked, 1)).alias("n_questions"),
        F.min(F.when(asked, F.col(order))).alias("question_from"),
        F.max(F.when(asked, F.col(order))).alias("question_to"),
        F.count(F.when(answered, 1)).alias("n_answers"),
        F.min(F.when(answered, F.col(order))).alias("answer_from"),
        F.max(F.when(answered, F.col(order))).alias("answer_to"),
    )
