"""Sentence ends with abbreviations learnt from the texts themselves.

A full stop after an abbreviation ends no sentence as a rule. Which words are abbreviations is told by
how they keep company with the stop (Kiss and Strunk, Unsupervised Multilingual Sentence Boundary
Detection, 2006): a word that nearly always has one behind it, is short and has stops within it. The
counts are aggregates over all texts; there is no list and no training text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.functions.passages import SPACE
from calltext.operators.staging import broadcast_if_small, stage

# Letters with stops inside them, and the stop that may follow.
WORD = r"\p{L}(?:[\p{L}.]*\p{L})?"
# Fixed values of the paper: how sure an abbreviation has its stop, and the least score of one.
SURE = 0.99
LEAST_SCORE = 0.3


def stop_counts(passages: DataFrame, text: str = "speaker_text") -> DataFrame:
    """``(word, n_with, n_without)``: how often each lower-case word of all texts has a full stop
    right behind it and how often it has none."""
    found = passages.select(F.explode(
        F.regexp_extract_all(text, F.lit(rf"{WORD}\.?"), F.lit(0))).alias("found"))
    stopped = F.col("found").endswith(".")
    word = F.lower(F.when(stopped, F.expr("left(found, length(found) - 1)")).otherwise(F.col("found")))
    return found.select(word.alias("word"), stopped.alias("stopped")).groupBy("word").agg(
        F.count_if("stopped").alias("n_with"), F.count_if(~F.col("stopped")).alias("n_without"))


def abbreviations(
    passages: DataFrame, text: str = "speaker_text", least_score: float = LEAST_SCORE
) -> DataFrame:
    """``(word, n_with, n_without, score)`` of the words that are held to be abbreviations.

    The score is a log-likelihood ratio of "as often as any word" and "nearly always", falling with
    the letters of the word, rising with the stops in it, and falling fast with each time the word
    stands without a stop. Texts without any stop give none.
    """
    counts = stage(stop_counts(passages, text))
    stops, rest = counts.agg(F.sum("n_with"), F.sum("n_without")).first()
    if not stops:
        return counts.withColumn("score", F.lit(0.0)).limit(0)
    # Were every word stopped, a stop would tell nothing; the share stays below one.
    share = min(stops / (stops + rest), SURE)
    n_with, n_without = F.col("n_with"), F.col("n_without")
    ratio = 2 * (n_with * (F.log(F.lit(SURE)) - F.log(F.lit(share)))
                 + n_without * (F.log(F.lit(1 - SURE)) - F.log(F.lit(1 - share))))
    letters = F.length(F.translate("word", ".", ""))
    inside = F.length("word") - letters
    score = ratio * F.exp(-letters) * (inside + 1) * F.pow(letters.cast("double"), -n_without)
    return counts.filter("n_with > 0").withColumn("score", score).filter(
        F.col("score") >= least_score)


def split_sentences(
    passages: DataFrame, known: DataFrame, keys: Sequence[str], text: str = "speaker_text"
) -> DataFrame:
    """``keys..., pos, sentence``: the sentences of each passage in order, from 0. ``keys`` tell
    passages apart. A sentence ends at ``. ! ?`` and white space, but not at a full stop after a word
    of ``known (word)`` unless nothing follows. White space between sentences is left out; NULL and
    empty texts give no rows.

    Pieces between stops meet the abbreviations in a join, which is broadcast after a check of its
    size; those of a passage are put together again in one aggregation.
    """
    marked = F.regexp_replace(text, rf"([.!?]{SPACE}+)", "$1\u0001")
    last = F.lower(F.regexp_extract("piece", rf"({WORD})\.{SPACE}+$", 1))
    pieces = passages.select(*keys, F.posexplode(F.split(marked, "\u0001")).alias("pos", "piece")
                             ).filter("piece <> ''").withColumn("word", last)
    table = broadcast_if_small(known.select("word").distinct().withColumn("goes_on", F.lit(True)))
    flagged = pieces.join(table, "word", "left").select(
        *keys, F.struct("pos", "piece", F.coalesce("goes_on", F.lit(False)).alias("goes_on")).alias("part"))
    together = flagged.groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))

    def add(state: Column, part: Column) -> Column:
        whole = F.concat(state["open"], part["piece"])
        return F.when(part["goes_on"], F.struct(state["done"].alias("done"), whole.alias("open"))
                      ).otherwise(F.struct(F.concat(state["done"], F.array(whole)).alias("done"),
                                           F.lit("").alias("open")))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    read = together.select(*keys, F.aggregate("parts", start, add).alias("read"))
    sentences = F.concat("read.done", F.when(F.col("read.open") != "", F.array("read.open"))
                         .otherwise(F.array().cast("array<string>")))
    return read.select(*keys, F.posexplode(sentences).alias("pos", "sentence")).withColumn(
        "sentence", F.regexp_replace("sentence", rf"([.!?]){SPACE}+$", "$1"))
