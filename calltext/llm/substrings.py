"""Substring dedup: windows of words that an earlier document holds too, found by super-k-mers."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import gram_hashes, joined_words, parallelism, text_batches
from calltext.operators.staging import stage

WINDOW = 50
# Words in a minimiser. Short ones give long super-k-mers, long ones are rarely frequent.
MINIMISER = 6
BUCKETS_PER_PARTITION = 4
# A minimiser with this many super-k-mers would fill a good part of a task's memory with them, about
# 500 bytes each, so its windows are dealt one by one. At most HOT_MINIMISERS, the most frequent
# ones, are told to the tasks.
HOT_MINIMISERS = 4096
HOT_COUNT = 40_000
GROUP_BYTES = 2 << 20
LAST_ID = 2**63 - 1


def _rolling_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each ``n`` neighbours."""
    width, least = 1, values
    while 2 * width <= n:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = n - width
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


class _Group:
    """Some documents, and their super-k-mers: runs of windows with one minimiser value."""

    def __init__(self, rows: pa.RecordBatch, texts: list[bytes], size: int) -> None:
        self.docs = rows.column("doc").to_numpy(zero_copy_only=False)
        self.sums = np.array([zlib.crc32(t) for t in texts], dtype=np.uint32)
        texts = [b" ".join(t.split()) for t in texts]
        self.data, self.starts, self.ends, hashes, self.first = joined_words(texts)
        n = min(MINIMISER, size)
        least = _rolling_min(gram_hashes(hashes, n), size - n + 1) if len(hashes) >= size else (
            np.empty(0, dtype=np.uint64))
        at = np.arange(len(least))
        text_of = np.searchsorted(self.first, at, "right") - 1
        whole = at + size <= self.first[text_of + 1]
        change = np.ones(len(least), dtype=bool)
        change[1:] = (least[1:] != least[:-1]) | (text_of[1:] != text_of[:-1])
        begin = np.flatnonzero(change)
        # Windows that reach into the next text end a run early; a run without whole ones is none.
        counts = np.add.reduceat(whole, begin) if len(begin) else begin
        keep = counts > 0
        self.begin, self.windows = begin[keep], counts[keep]
        self.minimiser, self.text = least[self.begin], text_of[self.begin]
        self.size = size


def _groups(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[_Group]:
    for rows, texts in text_batches(batches, "text", GROUP_BYTES):
        yield _Group(rows, texts, size)


def _minimisers(size: int):
    """For each minimiser of a group: its super-k-mers, and the least and greatest document."""

    def count(batches):
        for g in _groups(batches, size):
            order = np.argsort(g.minimiser, kind="stable")
            values, docs = g.minimiser[order], g.docs[g.text[order]]
            cut = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))[:len(values)]
            if len(values):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[cut].view(np.int64)),
                     pa.array(np.minimum.reduceat(docs, cut)),
                     pa.array(np.maximum.reduceat(docs, cut)),
                     pa.array(np.diff(np.append(cut, len(values))))], ["m", "low", "high", "n"])

    return count


def _places(size: int):
    """Minimiser and place of each super-k-mer."""

    def send(batches):
        for g in _groups(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.minimiser.view(np.int64)), pa.array(g.docs[g.text]),
                 pa.array(g.sums[g.text].astype(np.int64)),
                 pa.array((g.begin - g.first[g.text]).astype(np.int32)),
                 pa.array(g.windows.astype(np.int32))], ["m", "doc", "sum", "from", "windows"])

    return send


def _pack(*arrays: np.ndarray, text: bytes) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], dtype=np.int64)
    body = sizes.tobytes() + b"".join(a.tobytes() for a in arrays) + text
    return zstandard.ZstdCompressor(level=3).compress(body)


_TYPES = (np.int64, np.int64, np.int64, np.int64, np.uint32, np.int64)


def _unpack(blob: bytes) -> tuple[list[np.ndarray], bytes]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    at, arrays = 8 * len(_TYPES), []
    for size, kind in zip(np.frombuffer(body, np.int64, len(_TYPES)), _TYPES):
        arrays.append(np.frombuffer(body[at:at + size], kind))
        at += size
    return arrays, body[at:]


def _super_kmers(size: int, buckets: int):
    """Packed super-k-mers of some documents for each bucket: equal strings once, with the documents
    and places where they occur."""

    def send(batches):
        for rows, texts in text_batches(batches, "text", GROUP_BYTES):
            found: dict[int, dict[bytes, list]] = {}
            docs, sums = rows.column("doc").to_pylist(), rows.column("sum").to_pylist()
            for doc, sum_, text, places in zip(docs, sums, texts, rows.column("places").to_pylist()):
                words = text.split()
                for p in places:
                    m, at = p["m"], p["from"]
                    string = b" ".join(words[at:at + p["windows"] + size - 1])
                    found.setdefault(m % buckets, {}).setdefault(string, [m]).append((doc, sum_, at))
            names, blobs = list(found), []
            for where in found.values():
                uses = [x for members in where.values() for x in members[1:]]
                doc, sum_, at = zip(*uses)
                blobs.append(_pack(
                    np.array([x[0] for x in where.values()], dtype=np.int64),
                    np.array([len(s) for s in where], dtype=np.int64),
                    np.array([len(x) - 1 for x in where.values()], dtype=np.int64),
                    np.array(doc, dtype=np.int64), np.array(sum_, dtype=np.uint32),
                    np.array(at, dtype=np.int64), text=b"".join(where)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return send


def window_names(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each window of ``size`` neighbours: the same one exactly for equal windows.

    Names of longer windows come from sorting pairs of names of shorter ones, doubling the length.
    """
    names, width = ids.astype(np.int64), 1
    while width < size:
        step = min(width, size - width)
        pairs = names[:-step] * np.int64(names.max() + 1 if len(names) else 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width += step
    return names


def _resolve(blobs: list[bytes], size: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of covered words, ``(doc, sum, from, to)``, of the documents in one bucket."""
    parts = [_unpack(b) for b in blobs]
    minimiser, lengths, uses, docs, sums, places = (
        np.concatenate(x) for x in zip(*(p[0] for p in parts)))
    text = b"".join(p[1] for p in parts)
    if not len(minimiser):
        return
    use_at = np.concatenate(([0], np.cumsum(uses)))
    low, high = (f.reduceat(docs, use_at[:-1]) for f in (np.minimum, np.maximum))
    order = np.argsort(minimiser, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(minimiser[order]) != 0)))
    shared = np.minimum.reduceat(low[order], cut) < np.maximum.reduceat(high[order], cut)
    wanted = np.sort(order[np.repeat(shared, np.diff(np.append(cut, len(order))))])
    if not len(wanted):
        return
    text_at = np.concatenate(([0], np.cumsum(lengths)))
    same: dict[bytes, list[int]] = {}
    for i in wanted.tolist():
        same.setdefault(text[text_at[i]:text_at[i + 1]], []).append(i)
    number: dict[bytes, int] = {}
    ids, counts = [], []
    for string in same:
        tokens = string.split(b" ")
        counts.append(len(tokens))
        ids.extend([number.setdefault(t, len(number)) for t in tokens])
    names = window_names(np.array(ids), size)
    starts = np.concatenate(([0], np.cumsum(counts)))
    owner = np.array([min(low[i] for i in members) for members in same.values()])
    windows = np.array(counts) - size + 1
    # Windows inside the strings, each with the least document of its string.
    inside = np.repeat(starts[:-1] - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) + (
        np.arange(windows.sum()))
    best = np.full(int(names.max()) + 1, LAST_ID, dtype=np.int64)
    np.minimum.at(best, names[inside], np.repeat(owner, windows))
    first = best[names[inside]]
    at = 0
    for n, members in zip(windows.tolist(), same.values()):
        own = first[at:at + n]
        at += n
        least, most = int(own.min()), int(own.max())
        for i in members:
            for u in range(use_at[i], use_at[i + 1]):
                doc = int(docs[u])
                if doc > most:
                    yield doc, int(sums[u]), int(places[u]), int(places[u]) + n + size - 1
                elif doc > least:
                    hit = np.concatenate(([0], (own < doc).view(np.int8), [0]))
                    edge = np.flatnonzero(np.diff(hit))
                    for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
                        yield doc, int(sums[u]), int(places[u]) + a, int(places[u]) + b + size - 1


def _runs(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)],
        ["doc", "sum", "from", "to"])


def _resolved(size: int):
    """Bucket after bucket of a partition that is sorted by bucket."""

    def resolve(batches):
        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now and blobs:
                    yield _runs(list(_resolve(blobs, size)))
                    blobs = []
                now = bucket
                blobs.append(blob)
        if blobs:
            yield _runs(list(_resolve(blobs, size)))

    return resolve


def _hot_windows(size: int, hot: np.ndarray):
    """The windows of the most frequent minimisers, each with a 128-bit digest of its words."""

    def send(batches):
        for g in _groups(batches, size):
            out = []
            for i in np.flatnonzero(np.isin(g.minimiser, hot)).tolist():
                doc, sum_, base = g.docs[g.text[i]], g.sums[g.text[i]], g.first[g.text[i]]
                for w in range(g.begin[i], g.begin[i] + g.windows[i]):
                    words = g.data[g.starts[w]:g.ends[w + size - 1]]
                    out.append((hashlib.blake2b(words, digest_size=16).digest(), int(doc),
                                int(sum_), int(w - base)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                    ["digest", "doc", "sum", "from"])

    return send


def _drop_covered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_batches(batches, "text"):
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(texts, rows.column("spans")):
            words = text.split()
            n_words.append(len(words))
            spans = sorted(tuple(s.values()) for s in spans.as_py() or ())
            at, left = 0, []
            for a, b in spans:
                if a > at:
                    left.extend(words[at:a])
                at = max(at, b)
            left.extend(words[at:])
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays(
            [rows.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.string())], ["key", "n_words", "n_removed", "kept"])


def repeated_spans(texts: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(doc, sum, from, to)``: runs of words of ``texts (doc, text)`` in windows that also start in
    a row with a smaller ``doc``; ``sum`` is the CRC-32 of the row's text.

    Consecutive windows with one minimiser value make a super-k-mer. A minimiser that one document
    has alone is left out after the places of super-k-mers, without their words, have met the counts.
    The others travel as packed strings to the bucket of their minimiser, where the windows are
    named by sorting, exactly. Windows of the few most frequent minimisers do not meet in buckets:
    each is its own key, the least document per window is found by partial aggregation, and a join,
    whose skewed partitions adaptive execution splits, tells the later ones.
    """
    rows = texts.withColumn("sum", F.crc32(F.col("text").cast("binary")))
    counted = texts.mapInArrow(_minimisers(size), "m long, low long, high long, n long").groupBy(
        "m").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    # Staged, as it is read twice, and so that the join below meets it in an exchange of its own:
    # only then can adaptive execution split the places of a frequent minimiser.
    shared = stage(counted.filter("low < high"))
    # At most HOT_MINIMISERS numbers reach the driver and go back to the tasks.
    top = shared.filter(F.col("n") >= HOT_COUNT).orderBy(F.desc("n"), "m").limit(
        HOT_MINIMISERS).collect()
    hot = np.sort(np.array([r["m"] for r in top], dtype=np.int64))
    n = parallelism(texts)
    runs = "doc long, sum long, from long, to long"
    cold = shared.filter(~F.col("m").isin(hot.tolist())) if len(hot) else shared
    places = texts.mapInArrow(
        _places(size), "m long, doc long, sum long, from int, windows int"
    ).join(cold.select("m"), "m").groupBy("doc", "sum").agg(
        F.collect_set(F.struct("m", "from", "windows")).alias("places"))
    found = (
        rows.join(places, ["doc", "sum"])
        .mapInArrow(_super_kmers(size, n * BUCKETS_PER_PARTITION), "bucket int, blob binary")
        .repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_resolved(size), runs))
    if not len(hot):
        return found
    windows = stage(texts.mapInArrow(
        _hot_windows(size, hot.view(np.uint64)), "digest binary, doc long, sum long, from long"))
    first = stage(windows.groupBy("digest").agg(F.min("doc").alias("first")))
    late = windows.join(first, "digest").filter("doc > first").select(
        "doc", "sum", "from", (F.col("from") + size).alias("to"))
    return found.unionByName(late)


def without_repeats(
    docs: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_words, n_removed, kept)`` for every row of ``docs``: its text without the words that
    lie in a window of ``size`` words which also starts in a document with a smaller key, words
    joined by one space. All windows are judged on the input.

    Keys are whole numbers; a null key comes after all others. Rows with the same key do not remove
    each other's words. A null text has no words, a text of fewer than ``size`` words keeps all, and
    an empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(key), F.lit(LAST_ID)).cast("long").alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(rows, size).groupBy("doc", "sum").agg(
        F.collect_set(F.struct("from", "to")).alias("spans"))
    # The same exchange of the texts serves this join and the one that cuts the super-k-mers out.
    joined = rows.withColumn("sum", F.crc32(F.col("text").cast("binary"))).join(
        spans, ["doc", "sum"], "left")
    kept = joined.select(F.col("doc").alias("key"), "text", "spans").mapInArrow(
        _drop_covered, "key long, n_words long, n_removed long, kept string")
    own = F.when(F.col("key") != LAST_ID, F.col("key")).cast(docs.schema[key].dataType)
    return kept.select(own.alias(key), "n_words", "n_removed", "kept")
