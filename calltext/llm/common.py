"""Small helpers that the operators share: word arrays, exact global order, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.operators.staging import stage

# A word is a run of anything but the space and the five control characters \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
# Texts are worked on in pieces of about this many bytes, so memory does not follow batch sizes.
PIECE_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the hash base, grown when a piece is longer than any before."""

    up = _powers(_BASE, 1)
    down = _powers(_UNBASE, 1)

    @classmethod
    def for_length(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_UNBASE, n)
        return cls.up, cls.down


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit numbers, one to one for each seed."""
    x = x ^ np.uint64((seed * 0xD1342543DE82EF95 + seed) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 bytes start and end."""
    blank = np.ones(len(data) + 2, dtype=bool)
    blank[1:-1] = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[0::2], edges[1::2]


def hashed_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words. Equal words have equal hashes; the converse is
    only likely, so what must be exact compares the bytes."""
    starts, ends = word_bounds(data)
    up, down = _Tables.for_length(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return starts, ends, mix(value + (ends - starts).astype(np.uint64))


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text cut at white space into pieces of about ``size`` bytes; words stay whole."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not _BLANK[text[cut]]:
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def all_words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashed_words`` of a text of any length, a piece at a time."""
    if len(text) <= 2 * PIECE_BYTES:
        return hashed_words(np.frombuffer(text, dtype=np.uint8))
    at, found = 0, []
    for piece in pieces(text):
        starts, ends, hashes = hashed_words(np.frombuffer(piece, dtype=np.uint8))
        found.append((starts + at, ends + at, hashes))
        at += len(piece)
    return tuple(np.concatenate(x) for x in zip(*found))


def joined_words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts joined by line ends, with starts, ends and hashes of all words, and where each text's
    words begin among them (one more number than texts)."""
    data = b"\n".join(texts)
    starts, ends, hashes = all_words(data)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    return data, starts, ends, hashes, first


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``n`` neighbours, scrambled."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for j in range(n):
        total = total * np.uint64(_BASE) + hashes[j:len(hashes) - n + 1 + j]
    return mix(total)


def text_batches(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in groups of about ``limit`` bytes of text (at least one row), with their UTF-8 texts;
    a null text is empty."""
    for batch in batches:
        texts = batch.column(column)
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(
            zero_copy_only=False)
        mark = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            if end > at:
                part = batch.slice(at, end - at)
                yield part, [(x or "").encode() for x in part.column(column).to_pylist()]


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column | str) -> Column:
    """The words of a text as an array; empty for a null text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def marked(docs: DataFrame, key: str, *hashed: str) -> DataFrame:
    """``docs`` with its key and a hash of some columns under names of their own."""
    return docs.withColumns({
        "__row_key": F.col(f"`{key}`"), "__row_hash": F.xxhash64(*(F.col(f"`{c}`") for c in hashed))})


def rows_of(docs: DataFrame, chosen: DataFrame, key: str, *hashed: str, how: str = "left_semi"
            ) -> DataFrame:
    """The ``marked`` rows of ``docs`` that ``chosen (_key, _hash)`` names, null being equal to null;
    with ``how="left_anti"`` the others. ``docs`` may have columns of any other names."""
    return marked(docs, key, *hashed).alias("d").join(
        chosen.select("_key", "_hash").alias("c"),
        F.expr("d.__row_key <=> c._key AND d.__row_hash = c._hash"), how)


def unmarked(docs: DataFrame) -> DataFrame:
    return docs.drop("__row_key", "__row_hash")


def parallelism(df: DataFrame) -> int:
    """Partitions for an exchange that the caller sizes: what the session says for shuffles."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, *keys: str, rank: str = "rank") -> DataFrame:
    """``df`` staged in the order of ``keys``, each row with its 0-based place in it.

    Rows are range-partitioned and sorted within their partition. What reaches the driver is a
    count per partition. Keys should make a total order: rows that tie on all of them are numbered
    in any order, and the same keys meet in one partition.
    """
    place = F.monotonically_increasing_id()
    sliced = stage(
        df.repartitionByRange(parallelism(df), *keys).sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", place - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    counts = sorted((r[0], r[1]) for r in sliced.groupBy("_slice").count().collect())
    before, offsets = 0, []
    for number, count in counts:
        offsets.append((number, before))
        before += count
    table = df.sparkSession.createDataFrame(offsets or [(0, 0)], "_slice int, _before long")
    # One row per partition of the exchange above.
    return (
        sliced.join(F.broadcast(table), "_slice")
        .withColumn(rank, F.col("_before") + F.col("_place"))
        .drop("_slice", "_place", "_before"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: rows ``(node, component)`` for every node of an
    edge, the component being its least node.

    Rounds of large-star and small-star (Kiveris et al. 2014) as joins and aggregates, each staged.
    The least neighbour of a node is found by partial aggregation. It is staged before the links meet
    it in a join, as adaptive execution splits the links of a frequent node only where both sides
    come from exchanges of their own.
    """
    links = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct())
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stage(large)
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                    .alias("e")).select("e.a", "e.b").filter("a <> b").distinct())
        now = stage(small)
        changed = now.exceptAll(links).limit(1).count() or links.exceptAll(now).limit(1).count()
        links = now
        if not changed:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)
