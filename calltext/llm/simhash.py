"""SimHash fingerprints, compared bit plane by bit plane."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import (
    components, in_order, joined_words, mix, rows_of, text_batches, unmarked,
)
from calltext.operators.staging import stage

SEED = 42
SHINGLE = 3
RADIUS = 2
# Fingerprints that a bucket should hold, and the most that are compared in one task.
BUCKET = 512
MOST_IN_TASK = 16_384
QUERIES = 256  # fingerprints compared with a bucket at once
LAST_ID = 2**63 - 1
ALL = np.uint64(2**64 - 1)

_SPREAD = np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set among the hashes of each text; ``first`` is where the
    hashes of each text begin, and every text has some. Eight counters share a number, so texts are
    summed in parts of up to 255 hashes."""
    sizes = np.diff(np.append(first, len(hashes)))
    parts = -(-sizes // 255)
    part_of = np.concatenate(([0], np.cumsum(parts)[:-1]))
    begin = np.repeat(first, parts) + 255 * (np.arange(parts.sum()) - np.repeat(part_of, parts))
    counts = []
    for column in hashes.view(np.uint8).reshape(-1, 8).T:
        sums = np.add.reduceat(_SPREAD[column], begin).view(np.uint8).reshape(-1, 8)
        counts.append(np.add.reduceat(sums.astype(np.int64), part_of, axis=0))
    return np.concatenate(counts, axis=1)


def fingerprints(texts: list[bytes], shingle: int, numbers: int) -> np.ndarray:
    """``numbers`` times 64 bits for each text: those set in over half the hashes of its shingles.

    The first number's hashes are XXH64 of the shingle with seed 42, the others' are scrambled from
    them. A text of fewer words is one shingle, one without words has fingerprint 0.
    """
    texts = [b" ".join(t.lower().split()) for t in texts]
    data, starts, ends, _, first = joined_words(texts)
    count = np.diff(first)
    size = np.minimum(count, shingle)
    shingles = np.where(count > 0, count - size + 1, 0)
    offset = np.concatenate(([0], np.cumsum(shingles)))
    text_of = np.repeat(np.arange(len(texts)), shingles)
    at = np.arange(offset[-1]) - offset[text_of] + first[text_of]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(
            starts[at].tolist(), ends[at + size[text_of] - 1].tolist())),
        dtype=np.uint64, count=len(at))
    out = np.zeros((len(texts), numbers), dtype=np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        for k in range(numbers):
            counts = _bit_counts(mix(hashes, k) if k else hashes, offset[some])
            bits = (2 * counts > shingles[some, None]).astype(np.uint8)
            out[some, k] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprinted(shingle: int, numbers: int):
    def run(batches):
        for rows, texts in text_batches(batches, "text"):
            found = fingerprints(texts, shingle, numbers).byteswap()
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("hash"),
                 pa.array([x.tobytes() for x in found], pa.binary())], ["key", "hash", "print"])

    return run


def _planes(prints: list[bytes]) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a number."""
    bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), axis=1)
    padded = np.zeros((bits.shape[1], -(-len(prints) // 64) * 64), dtype=np.uint8)
    padded[:, :len(prints)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def _beyond(counters: list[np.ndarray], over: np.ndarray, limit: int) -> np.ndarray:
    """Lanes whose counter exceeds ``limit``."""
    more, same = over.copy(), ~over
    for i in range(len(counters) - 1, -1, -1):
        if limit >> i & 1:
            same = same & counters[i]
        else:
            more |= same & counters[i]
            same = same & ~counters[i]
    return more


def near(planes: np.ndarray, queries: np.ndarray, limits: list[tuple[int, int]]
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which fingerprints lie near each query: (query, number of a block of 64, lanes of the block).

    Distances of a block of 64 fingerprints to a query are counted together: each plane's difference
    is added to bit-sliced counters by carry-save steps. ``limits`` says after how many planes
    blocks are looked at, and which distance they may have by then; a block with all its lanes
    beyond is abandoned. The last limit is the radius.
    """
    width = max(limit for _, limit in limits).bit_length()
    query, block = (x.ravel() for x in np.indices((len(queries), planes.shape[1])))
    counters = [np.zeros(len(query), dtype=np.uint64) for _ in range(width)]
    over, at = np.zeros(len(query), dtype=np.uint64), 0
    for planes_done, limit in limits:
        for b in range(at, planes_done):
            carry = planes[b][block] ^ queries[query, b]
            for i in range(width):
                total = counters[i] ^ carry
                carry &= counters[i]
                counters[i] = total
            over |= carry
        at = planes_done
        alive = ~_beyond(counters, over, limit)
        keep = alive != 0
        query, block, over = query[keep], block[keep], over[keep] | ~alive[keep]
        counters = [c[keep] for c in counters]
    return query, block, ~_beyond(counters, over, limits[-1][1])


def _bucket_links(limits: list[tuple[int, int]]):
    """For each fingerprint of a bucket that has near ones, the least of its component there."""

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        side = table.column("part").to_numpy() if "part" in table.column_names else None
        order = np.argsort(ids)
        ids = ids[order]
        prints = table.column("print").to_pylist()
        prints = [prints[i] for i in order]
        planes, n = _planes(prints), len(ids)
        bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(n, -1), axis=1)
        label = np.arange(n)
        asked = np.arange(n)
        if side is not None and len(np.unique(side)) > 1:
            # Two parts of a large bucket: those of one are compared with all.
            asked = np.flatnonzero(side[order] == side.min())
        for begin in range(0, len(asked), QUERIES):
            own = asked[begin:begin + QUERIES]
            masks = np.where(bits[own] == 1, ALL, np.uint64(0))
            query, block, lanes = near(planes, masks, limits)
            hit = np.unpackbits(lanes[:, None].view(np.uint8), axis=1, bitorder="little")
            row, lane = np.nonzero(hit)
            a, b = own[query[row]], block[row] * 64 + lane
            inside = b < n
            a, b = a[inside], b[inside]
            while True:
                x, y = label[a], label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                root = np.arange(n)
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]
                label = root[label]
        linked = np.flatnonzero(label != np.arange(n))
        return pa.table({"a": pa.array(ids[linked]), "b": pa.array(ids[label[linked]])})

    return compare


def _tables(bits: int, radius: int, wide: float | None, n: int) -> list[list[int]]:
    """The bits that make up the bucket keys of each table.

    Within a small radius two near fingerprints agree on one of radius + 1 blocks whole, so the
    keys, the first bits of each block, miss nothing. For a wide radius (``wide``: the share of
    differing bits that must be found) keys are drawn bits, in so many tables that a pair at that
    share misses all of them once in a hundred times.
    """
    depth = max(1, math.ceil(math.log2(max(n, 1) / BUCKET))) if n > BUCKET else 0
    if wide is None:
        ends = [bits * i // (radius + 1) for i in range(radius + 2)]
        return [list(range(a, min(b, a + depth))) for a, b in zip(ends, ends[1:])]
    if not depth:
        return [[]]
    count = math.ceil(math.log(0.01) / math.log(1 - (1 - wide) ** depth))
    draw = np.random.default_rng(SEED)
    return [draw.choice(bits, depth, replace=False).tolist() for _ in range(count)]


def _keyed(tables: list[list[int]]):
    def deal(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            prints = rows.column("print")
            bits = np.unpackbits(np.frombuffer(b"".join(prints.to_pylist()), np.uint8).reshape(
                rows.num_rows, -1), axis=1)
            for t, places in enumerate(tables):
                key = np.zeros(rows.num_rows, dtype=np.int64)
                for p in places:
                    key = key << 1 | bits[:, p]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), t, np.int32)), pa.array(key), rows.column("id"),
                     prints], ["table", "key", "id", "print"])

    return deal


def _limits(bits: int, radius: int, wide: float | None) -> list[tuple[int, int]]:
    """When to look at the blocks. For a small radius any lane beyond it is out. For a wide one a
    near pair may at each look be four standard deviations above the share it should have."""
    looks = [b for b in (12, 16, 20, 24, 32, 48) if b < bits] if wide is None else [
        b for b in (64, 128, 256) if b < bits]
    share = radius / bits
    early = [(b, radius if wide is None else min(radius, math.floor(
        b * share + 4 * math.sqrt(b * share * (1 - share))))) for b in looks]
    return [*early, (bits, radius)]


def near_components(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, numbers: int = 1,
    wide: float | None = None, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(key, hash, print, component, first)`` for every row of ``docs``: its fingerprint of
    ``64 * numbers`` bits as hexadecimal digits, the number of its component under links of at most
    ``radius`` differing bits, and the least key of that component. ``hash`` is XXH64 of the text.

    Equal fingerprints are one node, so copies meet in an aggregation. Nodes are dealt into buckets
    that near ones share (see ``_tables``) and compared there in bit planes. A bucket that has more
    than ``MOST_IN_TASK`` nodes is cut into parts, and each two parts are a task, so no task grows;
    only links from a node to the least of its bucket's component leave a task.

    Keys are whole numbers; a null key comes after all others. A null text has no words, and all
    texts without words are one component. Repeated rows get equal results, an empty table none.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = stage(docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text")
    ).mapInArrow(_fingerprinted(shingle, numbers), f"key {kind}, hash long, print binary"))
    doc = F.coalesce("key", F.lit(LAST_ID)).cast("long")
    nodes = in_order(
        rows.groupBy("print").agg(F.min(doc).alias("doc")), "doc", "print", rank="id")
    n, bits = nodes.count(), 64 * numbers
    tables = _tables(bits, radius, wide, n)
    dealt = nodes.select("id", "print").mapInArrow(
        _keyed(tables), "table int, key long, id long, print binary")
    compare = _bucket_links(_limits(bits, radius, wide))
    large = stage(dealt.groupBy("table", "key").count().filter(F.col("count") > MOST_IN_TASK))
    links = dealt
    if large.isEmpty():
        edges = links.groupBy("table", "key").applyInArrow(compare, "a long, b long")
    else:
        parts = F.ceil(F.coalesce("count", F.lit(1)) / MOST_IN_TASK).cast("int")
        split = dealt.join(large, ["table", "key"], "left").withColumn("parts", parts).withColumn(
            "part", F.pmod(F.xxhash64("id"), "parts").cast("int")).withColumn(
                "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        edges = split.select(
            "table", "key", "id", "print", "part", F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high")).groupBy(
                "table", "key", "low", "high").applyInArrow(compare, "a long, b long")
    found = components(edges)
    first = nodes.select(F.col("id").alias("component"), F.col("doc").alias("first"))
    placed = (
        nodes.join(found, nodes["id"] == found["node"], "left")
        .withColumn("component", F.coalesce("component", "id"))
        .select("print", "component").join(first, "component"))
    least = F.when(F.col("first") != LAST_ID, F.col("first")).cast(kind)
    return rows.join(placed, "print").select(
        F.col("key").alias(key), "hash", F.lower(F.hex("print")).alias("print"), "component",
        least.alias("first"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near copies, by ``near_components`` with its shingle length and
    radius unless others are given: of each component the row with the least key stays,
    of several rows with that key the one whose text has the least hash, and of equal ones any."""
    found = near_components(docs, key=key, text=text, **options)
    chosen = found.groupBy("component").agg(F.min(F.struct(
        F.col(key).isNull().alias("last"), F.col(key).alias("k"), "hash")).alias("c")).select(
            F.col("c.k").alias("_key"), F.col("c.hash").alias("_hash"))
    rows = rows_of(docs, chosen, key, text).withColumn("__row_nth", F.expr(
        "row_number() OVER (PARTITION BY __row_key, __row_hash ORDER BY __row_hash)"))
    return unmarked(rows.filter("__row_nth = 1").drop("__row_nth"))
