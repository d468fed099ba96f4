"""Quality rules whose thresholds follow from quantile sketches per language and source."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import SPACE, rows_of, unmarked, words
from calltext.operators.staging import stage

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
# What the adaptive rules look at, in whole numbers, and by how much a document may leave the fence
# of its group: where all documents of a source agree, the fence alone would be a single value.
SLACK = {"symbols": 20, "word_length": 20, "repeated_lines": 350}
REACH = 6
# A sketch with fewer documents gives way to the merged sketch of its language, then of all.
LEAST_SUPPORT = 100
# Buckets are exact below 2 ** SKETCH_BITS, and 1 / 2 ** (SKETCH_BITS - 1) wide, relatively, above.
SKETCH_BITS = 6


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus word_chars, n_words, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    A null text has no words. Windows are found by hash first; only where two hashes agree are the
    windows compared as text, by sorting, so the counts are exact.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    first = docs.withColumns({
        "_words": words(text),
        "_lines": F.filter(F.split(content, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "word_chars": F.length(F.regexp_replace(content, SPACE + "+", "")).cast("long"),
        "n_symbols": F.regexp_count(content, F.lit(SYMBOLS)).cast("long"),
    })
    hashed = first.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    grams = hashed.withColumn("_grams", F.when(
        F.col("n_words") > WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW), lambda i: F.xxhash64(
            *(F.get("_hashes", i + j) for j in range(WINDOW))))))
    maybe = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = grams.withColumn("_sorted", F.when(maybe, F.array_sort(F.transform(
        F.sequence(F.lit(0), F.size("_grams") - 1), lambda i: F.struct(
            F.array_join(F.slice("_words", i + 1, WINDOW), " ").alias("g"), i.alias("i"))))))
    equal = placed.withColumn("_equal", F.zip_with(
        F.slice("_sorted", F.lit(1), F.size("_sorted") - 1),
        F.slice("_sorted", F.lit(2), F.size("_sorted") - 1), lambda a, b: a["g"] == b["g"]))
    starts = equal.withColumn("_starts", F.array_sort(F.filter(F.transform(
        "_sorted", lambda x, i: F.when(
            F.coalesce(F.get("_equal", i), F.lit(False))
            | F.coalesce(F.get("_equal", i - 1), F.lit(False)), x["i"])),
        lambda x: x.isNotNull())))
    covered = F.aggregate(
        F.zip_with(F.slice("_starts", F.lit(1), F.size("_starts") - 1),
                   F.slice("_starts", F.lit(2), F.size("_starts") - 1),
                   lambda a, b: F.least(b - a, F.lit(WINDOW))),
        F.lit(WINDOW), lambda total, x: total + x)
    return starts.withColumn("n_repeat_words", F.when(
        F.coalesce(F.size("_starts"), F.lit(0)) > 0, covered).otherwise(0).cast("long")
    ).drop("_words", "_lines", "_hashes", "_grams", "_sorted", "_equal", "_starts")


def base_failed() -> Column:
    """The two fixed rules over the measures."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """Whole-number values that the adaptive rules compare; all are defined for every text."""
    per = lambda a, b: F.floor(F.col(a) * 1000 / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {
        "symbols": per("n_symbols", "word_chars"),
        "word_length": F.floor(10 * F.col("word_chars") / F.greatest("n_words", F.lit(1))).cast("long"),
        "repeated_lines": per("n_dup_lines", "n_lines"),
    }


def bucket(value: Column) -> Column:
    """Bucket of a value of 0 or more in a log-linear quantile sketch, named by its lower end."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return value - F.pmod(value, F.pow(F.lit(2.0), shift).cast("long"))


def sketches(values: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Quantile sketches as rows ``(*keys, metric, bucket, n)``. Two sketches merge by adding ``n``,
    which is what the partial aggregation of each task's rows does."""
    long = values.select(*keys, F.explode(F.array(*(
        F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in metrics)
    )).alias("m")).select(*keys, "m.*")
    return long.groupBy(*keys, "metric", "bucket").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    group = ", ".join([*keys, "metric"])
    placed = sketch.withColumns({
        "_upto": F.expr(f"sum(n) OVER (PARTITION BY {group} ORDER BY bucket)"),
        "_all": F.expr(f"sum(n) OVER (PARTITION BY {group})")})
    quarter = lambda q: F.min(F.when(F.col("_upto") * 4 >= F.col("_all") * q, F.col("bucket")))
    return placed.groupBy(*keys, "metric").agg(
        quarter(1).alias("low"), quarter(3).alias("high"), F.max("_all").alias("support"))


def thresholds(sketch: DataFrame, slack: Mapping[str, int] = SLACK) -> DataFrame:
    """``(_lang, _source, fences)`` for every language and source of ``sketch``: per metric the
    lowest and highest accepted value, ``REACH`` interquartile ranges and the slack beyond the
    quartiles of the group, of its language, or of all, whichever first has enough documents."""
    levels = [["_lang", "_source"], ["_lang"], []]
    found = []
    for keys in levels:
        merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        found.append(_quartiles(merged, keys))
    allowed = F.create_map(*(F.lit(x) for pair in slack.items() for x in pair))[F.col("metric")]
    own, lang, every = (q.alias(f"q{i}") for i, q in enumerate(found))
    # ``every`` has one row per metric.
    joined = own.join(lang, F.expr("q0._lang <=> q1._lang AND q0.metric = q1.metric")).join(
        F.broadcast(every), F.expr("q0.metric = q2.metric"))
    pick = lambda c: F.when(F.expr(f"q0.support >= {LEAST_SUPPORT}"), F.col(f"q0.{c}")).when(
        F.expr(f"q1.support >= {LEAST_SUPPORT}"), F.col(f"q1.{c}")).otherwise(F.col(f"q2.{c}"))
    chosen = joined.select(
        "q0._lang", "q0._source", "q0.metric", pick("low").alias("low"), pick("high").alias("high"))
    room = REACH * (F.col("high") - F.col("low")) + allowed
    return chosen.groupBy("_lang", "_source").agg(F.map_from_entries(F.collect_list(F.struct(
        "metric", F.struct((F.col("low") - room).alias("least"), (F.col("high") + room).alias("most"))
    ))).alias("fences"))


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
           source: str = "source") -> DataFrame:
    """``(_key, _hash, measures ..., base_failed, kept)`` for every row of ``docs``; ``_hash`` is of
    text, language and source, on which the verdict depends.

    A row that fails the base rules is rejected and does not shape the sketches. Others are kept
    when each measure lies within the fences of their language and source. Null languages and
    sources are groups of their own; equal rows get equal verdicts; an empty table gives no rows.
    Thresholds are one row per language and source, joined by both; adaptive execution broadcasts
    them when they are small and splits a hot source when they are not.
    """
    values = rule_values()
    rows = stage(text_measures(docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang"),
        F.col(source).alias("_source"), F.xxhash64(text, lang, source).alias("_hash")),
        "_text").drop("_text").withColumn(
            "base_failed", base_failed()).withColumns(values))
    sketch = sketches(rows.filter(~F.col("base_failed")), ["_lang", "_source"], list(values))
    fences = stage(thresholds(sketch))
    joined = rows.alias("r").join(
        fences.alias("f"), F.expr("r._lang <=> f._lang AND r._source <=> f._source"), "left")
    within = reduce(lambda a, b: a & b, (
        F.col(f"r.{m}").between(F.col("f.fences")[m]["least"], F.col("f.fences")[m]["most"])
        for m in values))
    return joined.select("r.*", F.when(
        ~F.col("r.base_failed"), F.coalesce(within, F.lit(True))).otherwise(False).alias("kept"))


def kept_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
              source: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, unchanged: null and empty texts fail the base rules,
    repeated rows stay or go together, an empty table stays empty, columns of any names are carried."""
    good = judged(docs, key, text, lang, source).filter("kept")
    return unmarked(rows_of(docs, good, key, text, lang, source))
