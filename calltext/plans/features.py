"""Word-based features of passages.

Passages are split into tokens and the tokens looked up in a lexicon table, which is broadcast after
a check of its size. Only hits and one marker per passage go on, so the shuffle carries counts and
never text. Rows are grouped by the columns carried along and a digest of the text; identical rows
fall into one group, and the number of markers tells how many there were.

A lexicon too large for that is cut into parts by a hash of the word. The tokens of a passage travel
as one string for each part, a run, and are taken apart beside the part; see ``_met``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calltext.functions.passages import W, led_tokens, number_count, sentences, tokens, words
from calltext.operators.incremental import of_todo_files, replace_by_key
from calltext.operators.staging import (
    BROADCAST_BYTES, broadcast_if_small, is_broadcast, measured_size, stage,
)
from calltext.schemas import LINGUISTIC_FEATURES, TONE_CATEGORIES

_MARKER = ""  # no token is empty

# Characters for private use, which no token holds: one for each part of a lexicon, and the last
# between a word and its place.
_PARTS = [chr(code) for code in range(0xE000, 0xF8FF)]
_PLACED = chr(0xF8FF)
_PART = f"[{_PARTS[0]}-{_PARTS[-1]}]"
_NO_PART = f"[^{_PARTS[0]}-{_PARTS[-1]}]"
# Groups of a part of a lexicon and some of the passages, for each core.
_GROUPS_PER_CORE = 4


def _exploded(passages: DataFrame, carry: Sequence[str], text: str, items: Column) -> DataFrame:
    """One row per item and one with the marker, as ``carry..., __digest, __pos, __word``."""
    marked = F.concat(F.array(F.lit(_MARKER)), F.coalesce(items, F.array().cast("array<string>")))
    # The digest is a column of its own first, or it would be taken again for every item.
    digested = passages.select(
        *carry, F.unhex(F.sha2(text, 256)).alias("__digest"), marked.alias("__items"))
    # The outer form: for the inner one the optimizer adds a check for empty arrays next to the
    # scan, which would split every text twice. The marker keeps the array from being empty.
    return digested.select(
        *carry, "__digest", F.posexplode_outer("__items").alias("__pos", "__word"))


def _with_marker(lexicon: DataFrame) -> DataFrame:
    """The lexicon and a row for the marker with NULL in the other columns, broadcast if small."""
    marker = lexicon.sparkSession.range(1).select(F.lit(_MARKER).alias("word"))
    return broadcast_if_small(
        lexicon.filter(F.col("word") != _MARKER).unionByName(marker, allowMissingColumns=True))


def _key(carry: Sequence[str], text: str) -> Column:
    """Sixteen bytes for the text and the columns carried along, from their hashes."""
    values = [v for c in carry for v in (F.col(c).isNull(), F.col(c))]
    hashes = [F.xxhash64(F.lit(seed), *values).cast("string") for seed in (1, 2)]
    # A NULL text is left out, so it is no empty one.
    return F.substring(F.unhex(F.sha2(F.concat_ws(" ", *hashes, F.sha2(text, 256)), 256)), 1, 16)


def _runs(words: Column, part) -> Column:
    """The items of an array, one string for each part, every item after the part's character."""
    sorted_items = F.sort_array(F.transform(words, lambda w: F.concat(part(w), w)))
    run = F.lit(rf"({_PART}){_NO_PART}*+(?:\1{_NO_PART}*+)*+")
    return F.regexp_extract_all(F.array_join(sorted_items, ""), run, F.lit(0))


@contextmanager
def _beside_each_other(spark: SparkSession) -> Iterator[None]:
    """While a query of ``_met`` runs: both sides of its join are dealt by part and salt, which Spark
    would deal again by the word as well, a row for each token."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _met(
    passages: DataFrame, carry: Sequence[str], text: str, items: Column, known: DataFrame,
    measures: Sequence[str] = (),
) -> DataFrame:
    """The items found in ``known``, a staged table with the marker that is too large for a broadcast:
    ``__key, __carried, __item`` and its columns. An item is a word, or a word, ``_PLACED`` and more.

    ``__key`` stands for the text and the columns carried along. These are in ``__carried``, with
    ``__null`` for a NULL text and the ``measures`` of the text, in the row of the marker only. To be
    staged in ``_beside_each_other``.
    """
    spark = passages.sparkSession
    parts = min(len(_PARTS), -(-measured_size(known) // BROADCAST_BYTES))
    salts = -(-_GROUPS_PER_CORE * spark.sparkContext.defaultParallelism // parts)
    # Spark deals sides of fewer partitions than it would make itself again.
    dealt_to = max(parts * salts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = F.array(*(F.lit(mark) for mark in _PARTS[:parts]))

    def never_null(value: Column, instead=0) -> Column:
        """Or the optimizer adds checks of the join's keys, which compute them in the scan as well."""
        return F.coalesce(value, F.lit(instead))

    def number(word: Column) -> Column:
        return never_null(F.pmod(F.xxhash64(word), F.lit(parts)).cast("int"))

    def part(item: Column) -> Column:
        return F.get(marks, number(F.substring_index(item, _PLACED, 1)))

    keyed = passages.select(
        _key(carry, text).alias("__key"),
        F.struct(*carry, *measures, F.col(text).isNull().alias("__null")).alias("__carried"),
        F.concat(F.array(part(F.lit(_MARKER))), F.coalesce(
            _runs(items, part), F.array().cast("array<string>"))).alias("__runs"))
    runs = keyed.select("__key", "__carried", F.posexplode_outer("__runs").alias("__pos", "__run"))
    dealt = runs.select(
        "__key", F.when(F.col("__pos") == 0, F.col("__carried")).alias("__carried"),
        never_null(F.ascii(F.substring("__run", 1, 1)) - ord(_PARTS[0])).alias("__part"),
        never_null(F.pmod(F.xxhash64("__key"), F.lit(salts)).cast("int")).alias("__salt"), "__run",
    ).repartition(dealt_to, "__part", "__salt")
    exploded = dealt.select(
        "__key", "__carried", "__part", "__salt",
        F.explode_outer(F.regexp_extract_all("__run", F.lit(f"{_PART}({_NO_PART}*+)"), F.lit(1))
                        ).alias("__item"))
    lexicon = known.select(
        "*", number(F.col("word")).alias("__part"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"),
    ).repartition(dealt_to, "__part", "__salt").hint("shuffle_hash")
    word = never_null(F.substring_index("__item", _PLACED, 1), _MARKER)
    return exploded.withColumn("word", word).join(
        lexicon, ["__part", "__salt", "word"]).drop("__part", "__salt")


def _unpacked(carry: Sequence[str]) -> list[Column]:
    return [F.col("__carried").getField(c).alias(c) for c in carry]


def _copies(df: DataFrame) -> DataFrame:
    """As many rows as there were identical passages."""
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop(
        "__copy", "__copies", "__digest")


def _carried(passages: DataFrame, text: str, carry: Sequence[str] | None) -> list[str]:
    return list(carry) if carry is not None else [c for c in passages.columns if c != text]


def token_trie(lexicon: DataFrame, categories: Sequence[str] = TONE_CATEGORIES) -> DataFrame:
    """The entries of ``lexicon (category, word)`` as a trie of their tokens: a row ``(level, node,
    label, child)`` for each step, ``label`` being the next token as it is written, with what stands
    before it, and a number per category that is 1 where an entry of the category ends at ``child``.

    An entry that does not begin and end with a word character raises an error.
    """
    whole = F.col("word").rlike(rf"(?s)^{W}(?:.*{W})?$")
    checked = F.when(whole, F.col("word")).otherwise(
        F.raise_error(F.concat(F.lit("not a whole word: "), F.col("word"))))
    entries = lexicon.filter(F.col("word") != _MARKER).select(
        "category", led_tokens(checked).alias("parts"))
    steps = entries.select(
        "category", "parts", F.posexplode("parts").alias("place", "label")).select(
        (F.col("place") + 1).alias("level"), "label",
        F.array_join(F.slice("parts", F.lit(1), F.col("place")), "").alias("node"),
        F.array_join(F.slice("parts", F.lit(1), F.col("place") + 1), "").alias("child"),
        F.when(F.col("place") + 1 == F.size("parts"), F.col("category")).alias("ends"))
    return steps.groupBy("level", "node", "label", "child").agg(*(
        F.max(F.when(F.col("ends") == c, 1).otherwise(0)).alias(c) for c in categories))


def _stepped(passages: DataFrame, carry: Sequence[str], text: str, ahead: Sequence[Column]) -> DataFrame:
    """One row per token and one with the marker, as ``carry..., __digest, __word`` and the tokens
    after it, ``__next2``, ``__next3`` and so on, as they are written."""
    found = F.coalesce(tokens(text), F.array().cast("array<string>"))
    led = [F.coalesce(led_tokens(text), F.array().cast("array<string>")).alias("__led")] if ahead else []
    digested = passages.select(
        *carry, F.unhex(F.sha2(text, 256)).alias("__digest"), found.alias("__tokens"), *led)
    none = F.array(F.lit(None).cast("string"))
    names = [f"__next{k + 2}" for k in range(len(ahead))]
    # The marker stands first, so what follows it is nothing.
    zipped = F.arrays_zip(
        F.concat(F.array(F.lit(_MARKER)), F.col("__tokens")).alias("__word"),
        *(F.concat(none, column).alias(name) for name, column in zip(names, ahead)))
    together = digested.select(*carry, "__digest", zipped.alias("__items"))
    # The outer form: for the inner one the optimizer adds a check for empty arrays next to the
    # scan, which would split every text twice. The marker keeps the array from being empty.
    return together.select(*carry, "__digest", F.explode_outer("__items").alias("__item")).select(
        *carry, "__digest", *(F.col(f"__item.`{name}`").alias(name) for name in ["__word", *names]))


def tone_levels(lexicon: DataFrame, categories: Sequence[str] = TONE_CATEGORIES) -> DataFrame:
    """The trie and the marker, staged. ``tone_counts`` takes it in place of the lexicon, so that work
    in batches makes it once."""
    return broadcast_if_small(token_trie(lexicon, categories).unionByName(
        lexicon.sparkSession.range(1).select(
            F.lit(1).alias("level"), F.lit("").alias("node"), F.lit(_MARKER).alias("label"),
            F.lit(_MARKER).alias("child")), allowMissingColumns=True))


def _walked_phrases(
    passages: DataFrame, levels: DataFrame, depth: int, text: str, carry: Sequence[str],
    categories: Sequence[str],
) -> DataFrame:
    """``__key`` and the hits of entries of several tokens, a row for each place where one begins."""
    steps = [
        broadcast_if_small(levels.filter(F.col("level") == k).select(
            F.col("node").alias(f"__from{k}"), F.col("label").alias(f"__label{k}"),
            F.col("child").alias(f"__node{k}"), *(F.col(c).alias(f"__{k}_{c}") for c in categories)))
        for k in range(2, depth + 1)]
    starts = broadcast_if_small(steps[0].select(F.col("__from2").alias("__node1")).distinct())
    ahead = [F.slice("__led", k, F.greatest(F.size("__led"), F.lit(0))) for k in range(2, depth + 1)]
    keyed = passages.select(_key(carry, text).alias("__key"), text)
    walked = _stepped(keyed, ["__key"], text, ahead).join(starts, F.col("__word") == F.col("__node1"))
    for k, step in enumerate(steps, 2):
        walked = walked.join(
            step, (F.col(f"__node{k - 1}") == F.col(f"__from{k}"))
            & (F.col(f"__next{k}") == F.col(f"__label{k}")), "left" if k > 2 else "inner")
    return walked.select("__key", *(
        sum((F.coalesce(F.col(f"__{k}_{c}"), F.lit(0)) for k in range(2, depth + 1)), F.lit(0)).alias(c)
        for c in categories))


def _tone_counts_by_parts(
    passages: DataFrame, levels: DataFrame, depth: int, text: str, carry: Sequence[str],
    categories: Sequence[str],
) -> DataFrame:
    """``tone_counts`` by a trie that is too large for a broadcast. Entries of one token are met in
    parts. The others are few as a rule: where tokens begin one, they walk down from there."""
    ending = F.greatest(*(F.col(c) for c in categories), F.lit(0)) == 1
    single = levels.filter((F.col("level") == 1) & (ending | (F.col("label") == _MARKER))).select(
        F.col("label").alias("word"), *categories)
    met = _met(passages, carry, text, tokens(text), single)
    found = met.select("__key", "__carried", *(F.coalesce(c, F.lit(0)).alias(c) for c in categories))
    if depth > 1:
        found = found.unionByName(_walked_phrases(
            passages, levels, depth, text, carry, categories), allowMissingColumns=True)
    # The marker's row alone has the columns carried along; two rows a passage reach the second step.
    counted = found.groupBy("__key", "__carried").agg(
        F.count(F.when(F.col("__carried").isNotNull(), 1)).alias("__copies"),
        *(F.sum(c).alias(c) for c in categories))
    per_key = counted.groupBy("__key").agg(
        F.first("__carried", ignorenulls=True).alias("__carried"),
        F.sum("__copies").cast("int").alias("__copies"), *(F.sum(c).alias(c) for c in categories))
    with _beside_each_other(passages.sparkSession):
        per_key = stage(per_key)
    return _copies(per_key.select(
        *_unpacked(carry), "__copies", *(
            F.when(~F.col("__carried")["__null"], (F.col(c) / F.col("__copies")).cast("int")).alias(c)
            for c in categories)))


def tone_counts(
    passages: DataFrame, lexicon: DataFrame, text: str = "speaker_text",
    carry: Sequence[str] | None = None, categories: Sequence[str] = TONE_CATEGORIES,
) -> DataFrame:
    """``carry`` (default: all columns but the text) and the number of whole-word hits per category.

    Matching keeps case. ``lexicon`` holds ``category, word``. An entry of several tokens, such as
    ``well-known`` or ``can't``, counts wherever it stands as it is written, also beside a shorter
    entry within it: tokens walk down a trie of the entries, one join a level. NULL text gives NULL
    counts.
    """
    carry = _carried(passages, text, carry)
    levels = lexicon if "level" in lexicon.columns else tone_levels(lexicon, categories)
    # As many values as the longest entry has tokens.
    depth = levels.agg(F.max("level")).first()[0]
    if not is_broadcast(levels):
        return _tone_counts_by_parts(passages, levels, depth, text, carry, categories)

    def level(k: int) -> DataFrame:
        return levels.filter(F.col("level") == k).select(
            F.col("node").alias(f"__from{k}"), F.col("label").alias(f"__label{k}"),
            F.col("child").alias(f"__node{k}"), *(F.col(c).alias(f"__{k}_{c}") for c in categories))

    ahead = [F.slice("__led", k, F.greatest(F.size("__led"), F.lit(0))) for k in range(2, depth + 1)]
    found = _stepped(passages, carry, text, ahead)
    # Most tokens begin no entry and end here. The others carry their next tokens down the trie.
    walked = found.join(level(1), F.col("__word") == F.col("__label1"))
    for k in range(2, depth + 1):
        walked = walked.join(
            level(k), (F.col(f"__node{k - 1}") == F.col(f"__from{k}"))
            & (F.col(f"__next{k}") == F.col(f"__label{k}")), "left")
    is_marker = F.col("__word") == _MARKER
    hits = {c: sum((F.coalesce(F.col(f"__{k}_{c}"), F.lit(0)) for k in range(1, depth + 1)), F.lit(0))
            for c in categories}
    counted = walked.groupBy(*carry, "__digest").agg(
        F.count(F.when(is_marker, 1)).cast("int").alias("__copies"),
        *[F.coalesce(F.sum(hit), F.lit(0)).alias(c) for c, hit in hits.items()])
    per_row = counted.withColumns({
        c: F.when(F.col("__digest").isNotNull(), (F.col(c) / F.col("__copies")).cast("int"))
        for c in categories
    })
    return _copies(per_row)


def passage_features(
    passages: DataFrame, lexicon: DataFrame, text: str = "speaker_text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Tone counts of all categories and the number count, without the text."""
    carry = _carried(passages, text, carry)
    counted = passages.select(*carry, text, number_count(text).alias("num_count"))
    return tone_counts(counted, lexicon, text).select(*carry, *TONE_CATEGORIES, "num_count")


def update_features(
    passages: DataFrame, todo_keys: DataFrame, lexicon: DataFrame, previous: DataFrame
) -> DataFrame:
    """The feature table after working through the files of ``todo_keys``."""
    carry = [c for c in LINGUISTIC_FEATURES.names if c not in (*TONE_CATEGORIES, "num_count")]
    fresh = passage_features(
        of_todo_files(passages, todo_keys).select(*carry, "speaker_text"), lexicon)
    return replace_by_key(previous, fresh, "file_name", processed=todo_keys)


def word_stats(text: Column | str) -> list[Column]:
    """``sent_count, word_count, word_7_count`` of a text."""
    found = words(text)
    return [
        F.array_size(sentences(text)).alias("sent_count"),
        F.array_size(found).alias("word_count"),
        F.array_size(F.filter(found, lambda w: F.length(w) >= 7)).alias("word_7_count"),
    ]


def syllable_lexicon(pronunciations: DataFrame) -> DataFrame:
    """``word, n_syllables`` from ``word, phones``: sounds with a stress digit, the largest number
    over a word's pronunciations."""
    stressed = F.size(F.filter("phones", lambda phone: phone.rlike("[0-9]")))
    return pronunciations.groupBy("word").agg(F.max(stressed).alias("n_syllables"))


def _syllable_sums() -> list[Column]:
    """Over a passage's rows of ``__syl``, which the marker lacks, and ``__count``."""
    return [
        F.max(F.when(F.col("__syl").isNull(), F.col("__count"))).alias("__copies"),
        F.coalesce(F.sum(F.col("__syl") * F.col("__count")), F.lit(0)).alias("__total"),
        F.array_sort(F.collect_list(
            F.when(F.col("__syl").isNotNull(), F.struct("__syl", "__count")))).alias("__histogram"),
    ]


def _syllable_record(of_text: Callable[[str], Column]) -> Column:
    """The record, with the columns that are taken from the text itself by ``of_text``."""
    copies = F.col("__copies")
    return F.struct(
        of_text("__sents").alias("sent_count"),
        of_text("__n").alias("word_count"),
        of_text("__n7").alias("word_7_count"),
        (F.col("__total") / copies).cast("int").alias("num_syllables"),
        F.map_from_entries(F.transform("__histogram", lambda e: F.struct(
            e["__syl"], (e["__count"] / copies).cast("int")))).alias("syllable_counts"),
    )


def _syllables_by_parts(
    base: DataFrame, known: DataFrame, text: str, carry: Sequence[str]
) -> DataFrame:
    """``syllable_features`` by a lexicon that is too large for a broadcast."""
    found = F.transform("__words", F.lower)
    per_key = (
        _met(base, carry, text, found, known, ["__sents", "__n", "__n7"])
        .groupBy("__key", "__carried", "__syl").agg(F.count("*").cast("int").alias("__count"))
        .groupBy("__key").agg(
            F.first("__carried", ignorenulls=True).alias("__carried"), *_syllable_sums())
    )
    with _beside_each_other(base.sparkSession):
        per_key = stage(per_key)
    of_text = F.col("__carried").getField
    return _copies(per_key.select(
        *_unpacked(carry), "__copies",
        F.when(~of_text("__null"), _syllable_record(of_text)).alias("syllable_data")))


def syllable_features(
    passages: DataFrame, lexicon: DataFrame, text: str = "speaker_text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``carry`` and ``syllable_data``: a struct of sentence and word counts, the syllables of the
    words that ``lexicon`` (``word, n_syllables``) knows, and how often each number occurs."""
    carry = _carried(passages, text, carry)
    base = passages.select(*carry, text, F.array_size(sentences(text)).alias("__sents"),
                           words(text).alias("__words"))
    base = base.withColumns({
        "__n": F.array_size("__words"),
        "__n7": F.array_size(F.filter("__words", lambda w: F.length(w) >= 7)),
    })
    known = _with_marker(lexicon.select("word", F.col("n_syllables").cast("int").alias("__syl")))
    if not is_broadcast(known):
        return _syllables_by_parts(base, known, text, carry)
    keys = [*carry, "__sents", "__n", "__n7", "__digest"]
    per_number = (
        _exploded(base, keys[:-1], text, F.col("__words")).drop("__pos")
        .join(known, F.lower("__word") == F.col("word"))
        .groupBy(*keys, "__syl")
        .agg(F.count("*").cast("int").alias("__count"))
    )
    # One row per passage and syllable number reaches this second step.
    counted = per_number.groupBy(*keys).agg(*_syllable_sums())
    per_row = counted.select(
        *carry, "__digest", "__copies",
        F.when(F.col("__digest").isNotNull(), _syllable_record(F.col)).alias("syllable_data"))
    return _copies(per_row)


def syllable_json(df: DataFrame, column: str = "syllable_data") -> DataFrame:
    """The record as JSON text, for sinks."""
    return df.withColumn(column, F.to_json(column))


def _long_words_by_parts(
    passages: DataFrame, chosen: DataFrame, text: str, carry: Sequence[str], longer_than: int
) -> DataFrame:
    """``long_words`` by a lexicon that is too large for a broadcast: words travel with their places."""
    base = passages.select(*carry, text, words(text).alias("__words"))
    placed = F.filter(
        F.transform("__words", lambda w, place: F.concat(
            F.lower(w), F.lit(_PLACED), place.cast("string"))),
        lambda item: F.length(F.substring_index(item, _PLACED, 1)) > longer_than)
    # Identical passages give each item several times; sets hold it once.
    gathered = _met(base, carry, text, placed, chosen).groupBy("__key").agg(
        F.first("__carried", ignorenulls=True).alias("__carried"),
        F.count(F.when(F.col("__carried").isNotNull(), 1)).cast("int").alias("__copies"),
        F.collect_set(F.when(F.col("__carried").isNull(), F.col("__item"))).alias("__found"))
    with _beside_each_other(passages.sparkSession):
        gathered = stage(gathered)
    in_order = F.array_sort(F.transform("__found", lambda item: F.struct(
        F.substring_index(item, _PLACED, -1).cast("int").alias("pos"),
        F.substring_index(item, _PLACED, 1).alias("word"))))
    return _copies(gathered.select(
        *_unpacked(carry), "__copies",
        F.when(~F.col("__carried")["__null"], F.transform(in_order, lambda e: e["word"])
               ).alias("long_words")))


def long_words(
    passages: DataFrame, lexicon: DataFrame, text: str = "speaker_text",
    carry: Sequence[str] | None = None, syllables: int = 3, longer_than: int = 3,
) -> DataFrame:
    """``carry`` and ``long_words``: the lower-case words, in order and repeated, of at least
    ``syllables`` syllables and more than ``longer_than`` characters; unknown words are left out."""
    carry = _carried(passages, text, carry)
    chosen = _with_marker(
        lexicon.filter((F.col("n_syllables") >= syllables) & (F.length("word") > longer_than))
        .select("word")
    )
    if not is_broadcast(chosen):
        return _long_words_by_parts(passages, chosen, text, carry, longer_than)
    # Identical passages give each word at each place several times; it is counted before the words
    # of a passage are gathered, so that no row grows with the number of copies.
    counted = (
        _exploded(passages, carry, text, words(text))
        .join(chosen, F.lower("__word") == F.col("word"))
        .groupBy(*carry, "__digest", "__pos", "word").agg(F.count("*").cast("int").alias("__n"))
    )
    is_marker = F.col("word") == _MARKER
    gathered = counted.groupBy(*carry, "__digest").agg(
        F.max(F.when(is_marker, F.col("__n"))).alias("__copies"),
        F.array_sort(F.collect_list(
            F.when(~is_marker, F.struct("__pos", "word")))).alias("__found"))
    per_row = gathered.select(
        *carry, "__digest", "__copies",
        F.when(F.col("__digest").isNotNull(),
               F.transform("__found", lambda e: e["word"])).alias("long_words"))
    return _copies(per_row)


def lexicon_table(lexicon: DataFrame) -> DataFrame:
    """``category, word_list`` with each category's words in alphabetical order, and ``url``, where a
    category's words come from, if the lexicon tells it."""
    url = [F.min("url").alias("url")] if "url" in lexicon.columns else []
    return lexicon.groupBy("category").agg(
        F.array_sort(F.collect_list("word")).alias("word_list"), *url)
