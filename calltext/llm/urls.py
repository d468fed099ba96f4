"""URL filter: rules first, then naive Bayes over the words that host and path are made of."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.operators.staging import stage

# (verdict, host and path): a rule fits its host and all subdomains where the path starts with its
# own; the longest that fits decides.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
LONGEST_WORD = 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without a ``://``."""
    # The lazy start ends at the first ``://``.
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(known, PARTS, 2)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES
          ) -> tuple[Column, Column]:
    """The rule that decides and its verdict, both null where none fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _tokens(host: Column, path: Column) -> Column:
    """(side, token) for each run of letters or digits; digits count by how many they are."""
    def side(name: str, text: Column) -> Column:
        runs = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(r"[0-9]+|\p{L}+"), F.lit(0))
        return F.transform(runs, lambda t: F.struct(
            F.lit(name).alias("side"),
            F.when(t.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(t).cast("string"))).otherwise(t)
            .alias("token")))

    return F.concat(side("host", host), side("path", path))


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(word, n)``: how often each word of letters, of any script, stands in the pages outside tags.
    Words of more than ``LONGEST_WORD`` letters are no parts of names."""
    plain = F.lower(F.regexp_replace(F.col(html), r"<[^<>]*>", " "))
    return pages.select(F.explode(F.split(plain, r"\P{L}+")).alias("word")).filter(
        F.col("word").rlike(rf"^\p{{L}}{{1,{LONGEST_WORD}}}$")).groupBy("word").agg(
            F.count("*").alias("n"))


def segment(token: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest split of ``token`` into words by unigram Viterbi.

    ``known`` has the counts of its substrings by (start, length). A substring that was never seen
    costs ten times more with each letter. Ties go to the split whose last word is longer.
    """
    best, last = [0.0], [0]
    for end in range(1, len(token) + 1):
        found = None
        for start in range(max(0, end - LONGEST_WORD), end):
            n = known.get((start, end - start))
            cost = math.log(n / total) if n else math.log(10 / max(total, 1)) - (
                end - start) * math.log(10)
            if found is None or best[start] + cost > found[0]:
                found = best[start] + cost, start
        best.append(found[0])
        last.append(found[1])
    words, end = [], len(token)
    while end:
        words.append(token[last[end]:end])
        end = last[end]
    return words[::-1]


def _segmented(total: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            tokens = rows.column("token").to_pylist()
            words = [segment(t, {(k["at"], k["size"]): k["n"] for k in known}, total)
                     for t, known in zip(tokens, rows.column("known").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("token"), pa.array(words, pa.list_(pa.string()))], ["token", "words"])

    return run


def segmented(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """``(token, words)`` for distinct ``tokens (token)``. Substrings meet the word counts in a join,
    so the vocabulary is never sent to every task; a token gathers at most ``LONGEST_WORD`` counts
    for each of its letters."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    letters = tokens.filter(F.length("token") > 0)
    places = F.flatten(F.transform(
        F.sequence(F.lit(0), F.length("token") - 1), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("token") - i)),
            lambda n: F.struct(i.alias("at"), n.alias("size")))))
    parts = letters.select("token", F.explode(places).alias("p")).select(
        "token", "p.*", F.substring("token", F.col("p.at") + 1, F.col("p.size")).alias("word"))
    known = parts.join(counts, "word").groupBy("token").agg(
        F.collect_list(F.struct("at", "size", "n")).alias("known"))
    none = F.array().cast("array<struct<at:int,size:int,n:bigint>>")
    return letters.join(known, "token", "left").select(
        "token", F.coalesce("known", none).alias("known")).mapInArrow(
            _segmented(total), "token string, words array<string>")


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, key: str = "page_id",
    url: str = "url", html: str = "html",
) -> DataFrame:
    """``(key, host, path, rule, verdict, block_score)`` for every row of ``pages``.

    Where no rule fits, multinomial naive Bayes decides, learnt from all pages that rules judge: its
    features are the words into which host and path names split, host and path apart, and numbers by
    their length. ``block_score`` is the log odds for block, null where a rule decides; above 0
    blocks. Each host and path is scored once, and frequent words are summed by each task first;
    the joins' skewed partitions are left to adaptive execution.

    A null url has empty host and path and is judged by the share of blocked pages alone, as is one
    without letters or digits. Without pages that rules judge, everything else is allowed. Repeated
    rows get equal results, an empty table none; null html has no words.
    """
    host, path = parsed(F.col(url))
    rows = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    urls = stage(rows.groupBy("host", "path").agg(F.count("*").alias("n")).withColumns(
        {"rule": rule, "verdict": verdict}))
    tokens = urls.select("host", "path", "n", "verdict", F.explode(
        _tokens(F.col("host"), F.col("path"))).alias("t")).select(
            "host", "path", "n", "verdict", "t.*")
    names = tokens.filter(~F.col("token").startswith("#")).select("token").distinct()
    words = segmented(stage(names), stage(word_counts(pages, html)))
    features = stage(tokens.join(words, "token", "left").select(
        "host", "path", "n", "verdict", F.explode(F.coalesce("words", F.array("token"))).alias("w"),
        "side").withColumn("word", F.concat_ws(":", "side", "w")).drop("w", "side"))
    count = lambda v: F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col("n"))), F.lit(0))
    model = stage(features.filter("verdict IS NOT NULL").groupBy("word").agg(
        count("allow").alias("allowed"), count("block").alias("blocked")))
    size, allowed, blocked = model.agg(
        F.count("*"), F.coalesce(F.sum("allowed"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))
    ).first()
    pages_allowed, pages_blocked = urls.agg(count("allow"), count("block")).first()
    prior = math.log((pages_blocked + 1) / (pages_allowed + 1))
    # Add-one smoothing; a word that no judged page has counts as seen zero times by both.
    seen = lambda c: F.coalesce(c, F.lit(0)) + 1.0
    odds = F.log(seen(F.col("blocked")) / (blocked + size + 1)) - F.log(
        seen(F.col("allowed")) / (allowed + size + 1))
    scores = features.filter("verdict IS NULL").join(model, "word", "left").groupBy(
        "host", "path").agg(F.round(F.sum(odds) + prior, 9).alias("score"))
    trained = F.lit(bool(pages_allowed or pages_blocked))
    same = F.expr("u.host = s.host AND u.path = s.path")
    # Staged, so that pages meet it in an exchange of its own and a frequent url can be split.
    verdicts = stage(urls.alias("u").join(scores.alias("s"), same, "left").select(
        "u.host", "u.path", "u.rule", "u.verdict", F.when(F.col("u.verdict").isNull(), F.when(
            trained, F.coalesce("s.score", F.lit(prior))).otherwise(0.0)).alias("block_score")))
    return rows.join(verdicts, ["host", "path"]).select(
        F.col("_key").alias(key), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("block_score") > 0, "block").otherwise("allow"))
        .alias("verdict"), "block_score")
