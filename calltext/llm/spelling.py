"""Spelling variants: words that differ from a much more frequent word by one letter.

Two words are near if one inserted, deleted or replaced letter turns one into the other. Near words
are found over bit planes: for a position and a letter, one bit per word of a set tells whether the
word has that letter there. A query walks along its own letters and keeps three sets of words at once:
those that agree so far, those that agree but for one replaced letter, and those that have one letter
more, which read their planes one position further on. Each step is a few operations on 64 words.

Words meet only where they can be near. A word of n letters is cut into ``PARTS`` parts; if the letter
that differs lies in one part, all letters before and after it are the same. So a word goes to one
group for each part, named by its other letters, and to those of words one letter shorter. A group
looks for differences in its own part only, and of several places where a letter may have been put
in, as in a run of equal letters, takes the first, so each pair is found once.

* A null text has no words, one of any length is read whole, in memory that follows the text. Repeated
  rows count each time. A null key leaves the words of its text as they are.
* Ties between forms go to the first in code-point order. An empty table gives no rows.
* What grows with a group of words is a row for each of them, not for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import parallelism
from calltext.operators.staging import stage

# Maximal runs of these; only A-Z have their case changed.
LETTERS = r"[A-Za-zÀ-ÿ]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words shorter or rarer than these are not looked at; a form is RATIO times as frequent.
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
# One run in so many loses a letter before it is counted.
SLIP = 31
# More parts make smaller groups and more rows: twice as many as there are parts for each word.
PARTS = 4
# Queries times lanes of 64 words worked on at once: some 100 bytes each.
_LANES = 1 << 17


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of the long words of all texts that occur more than once, slips included."""
    runs = docs.select(
        F.col(key).cast("string").alias("key"),
        F.explode(F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()),
                                       F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= LEAST_LENGTH)
    chance = F.crc32(F.concat("key", F.lit(":"), "run"))
    at = (chance % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(chance % SLIP == 0, slipped).otherwise(F.col("run"))
    return (
        runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT))


# -- groups of words that may be near ----------------------------------------------------------------


def grouped(vocabulary: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """``(length, part, name, word, n)``: each word of ``least`` letters or more once for each group
    it belongs to. A group is for words of ``length`` letters and of one more, and for differences in
    ``part``."""
    size = F.length("word")
    cuts = vocabulary.select(
        "word", "n", F.explode(F.array(size, size - 1)).alias("length")
    ).filter(F.col("length") >= least).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    start = F.expr(f"int(length * part div {PARTS})")
    end = F.expr(f"int(length * (part + 1) div {PARTS})")
    before = F.substring("word", F.lit(1), start)
    after = F.substring("word", F.length("word") - F.col("length") + end + 1, F.length("word"))
    return cuts.select(
        "length", "part", F.xxhash64("length", "part", before, after).alias("name"), "word", "n")


def _letters(found: list[str], width: int) -> np.ndarray:
    """One row of ``width`` letter numbers per word; 0 stands behind the end."""
    codes = np.array(found, dtype=f"U{width}").view(np.uint32).reshape(len(found), width)
    used = np.zeros(int(codes.max(initial=0)) + 1, dtype=bool)
    used[codes] = used[0] = True
    return (np.cumsum(used) - 1)[codes]


def _planes(codes: np.ndarray, position: int, letters: int) -> np.ndarray:
    """For each letter the words that have it at ``position``, 64 to a lane; none have letter 0."""
    words_, width = codes.shape
    lanes = -(-words_ // 64)
    bits = np.zeros((letters, lanes * 64), dtype=np.uint8)
    if position < width:
        bits[codes[:, position], np.arange(words_)] = 1
        bits[0] = 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ranges of words, one after another: which range, which lane, and its bits within it."""
    first, last = starts // 64, (ends - 1) // 64
    count = last - first + 1
    which = np.repeat(np.arange(len(starts)), count)
    lane = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[which]
    low = np.clip(starts[which] - lane * 64, 0, 63).astype(np.uint64)
    high = np.clip(lane * 64 + 64 - ends[which], 0, 63).astype(np.uint64)
    full = np.uint64(2**64 - 1)
    return which, lane, (full << low) & (full >> high)


def _positions(which: np.ndarray, lane: np.ndarray, found: np.ndarray) -> Iterator[tuple]:
    """Pairs (query, word) of the bits that are set, some at a time."""
    some = np.flatnonzero(found)
    for at in range(0, len(some), 1 << 16):
        part = some[at:at + (1 << 16)]
        bits = np.unpackbits(found[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(bits)
        yield which[part[row]], lane[part[row]] * 64 + bit


def near_pairs(found: list[str], names: np.ndarray, length: int, part: int) -> Iterator[tuple]:
    """Arrays (query, other) of near words among words sorted by the ``names`` of their groups: a
    query has ``length`` letters; others have as many, and are found from both sides, or one more,
    and are found from here only."""
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    codes = _letters(found, length + 1)
    letters = int(codes.max(initial=0)) + 1
    edges = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1], [True])))
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    start, end = edges[group], edges[group + 1]
    queries = np.flatnonzero((sizes == length) & (end - start > 1))
    lanes = -(-len(found) // 64)
    same = np.packbits(np.pad(sizes == length, (0, lanes * 64 - len(found))),
                       bitorder="little").view(np.uint64)
    longer = np.packbits(np.pad(sizes == length + 1, (0, lanes * 64 - len(found))),
                         bitorder="little").view(np.uint64)
    low, high = length * part // PARTS, length * (part + 1) // PARTS
    per_query = (end[queries] - 1) // 64 - start[queries] // 64 + 1
    blocks = np.cumsum(per_query) // _LANES
    for number in np.unique(blocks):
        mine = queries[blocks == number]
        which, lane, inside = _spread(start[mine], end[mine])
        own = codes[mine]
        agree, replaced = inside, np.zeros_like(inside)
        added = inside.copy() if part == 0 else np.zeros_like(inside)
        here = _planes(codes, 0, letters)
        for i in range(length):
            ahead = _planes(codes, i + 1, letters)
            letter = own[which, i]
            at, next_at = here[letter, lane], ahead[letter, lane]
            replaced = replaced & at
            if low <= i < high:
                replaced = replaced | (agree & ~at)
            agree = agree & at
            added = added & next_at
            # A letter equal to the one before it was counted as put in there.
            if low < i + 1 <= high:
                added = added | (agree & ~next_at)
            here = ahead
        for bits in (replaced & same[lane], added & longer[lane]):
            for query, other in _positions(which, lane, bits):
                yield mine[query], other


def _per_word(table: pa.Table) -> pa.Table:
    """For the groups in ``table``, ``(word, n_near, form_n, form)`` of each word that has a near one:
    how many, and the most frequent of them."""
    table = table.sort_by("name")
    found, names = table.column("word").to_pylist(), table.column("name").to_numpy()
    count = table.column("n").to_numpy()
    # Among words as frequent the first in code-point order comes first.
    order = np.array(sorted(range(len(found)), key=lambda i: (-count[i], found[i])))
    place = np.empty(len(found), dtype=np.int64)
    place[order] = np.arange(len(found))
    number = np.zeros(len(found), dtype=np.int64)
    best = np.full(len(found), len(found), dtype=np.int64)
    length, part = table.column("length")[0].as_py(), table.column("part")[0].as_py()
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    for query, other in near_pairs(found, names, length, part):
        np.add.at(number, query, 1)
        np.minimum.at(best, query, place[other])
        back = sizes[other] > length
        np.add.at(number, other[back], 1)
        np.minimum.at(best, other[back], place[query[back]])
    some = np.flatnonzero(number)
    form = order[best[some]]
    return pa.table({"word": pa.array([found[i] for i in some], pa.string()), "n_near": number[some],
                     "form_n": count[form],
                     "form": pa.array([found[i] for i in form], pa.string())})


def near_counts(vocabulary: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n_near, form_n, form)`` of the words of ``vocabulary (word, n)`` that have near words,
    both of ``least`` letters or more: how many, and the most frequent one. Distinct words only."""
    slices = parallelism(vocabulary)
    # Groups are dealt to as many slices as the session has partitions; a slice is worked on at once.
    parts = grouped(vocabulary, least).withColumn("slice", F.pmod("name", F.lit(slices)))
    some = parts.groupBy("length", "part", "slice").applyInArrow(
        _per_word, "word string, n_near long, form_n long, form string")
    return some.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best"),
    ).select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of each word of ``vocabulary (word, n)``.

    A form is ``ratio`` times as frequent, so the way from a word to its root has few steps: it is
    halved in each round of joins, on the words that have a form.
    """
    vocabulary = stage(vocabulary)
    joined = stage(vocabulary.join(near_counts(vocabulary), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c)
          for c in ("form", "form_n"))))
    way = stage(joined.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = stage(way.alias("a").join(
            way.select(F.col("word").alias("at"), F.col("root").alias("next")), F.expr("root = at"),
            "left").select("word", F.coalesce("next", "root").alias("root"),
                           F.col("next").isNotNull().alias("moved")))
        way = further.drop("moved")
        if not further.filter("moved").limit(1).count():
            break
    return joined.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
