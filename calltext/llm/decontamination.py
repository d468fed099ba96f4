"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from calltext.llm.common import all_words, gram_hashes, joined_words, text_batches
from calltext.operators.staging import stage

SEED = 5
COVERAGE = 0.5
# Items are compared in blocks of about this many words, each sent to every task: about 40 bytes a
# word. More items mean more passes over the documents, not larger blocks.
BLOCK_WORDS = 500_000


def tile(item: list[bytes], doc: list[bytes], seeds: Iterable[tuple[int, int]], least: int = SEED
         ) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(start in item, start in document, length)`` of the tiles.

    ``seeds`` are the places (in item, in document) where ``least`` words may agree. Neighbouring
    seeds grow to maximal matches; the longest match whose words are all unmarked is marked, again
    and again, and one that has lost words to longer ones stays in the race with what it has left.
    Ties go to the earlier place in the item, then in the document.
    """
    diagonals = defaultdict(list)
    for p, q in seeds:
        diagonals[q - p].append(p)
    heap = []
    for shift, places in diagonals.items():
        places.sort()
        start = last = places[0]
        for p in [*places[1:], None]:
            if p is None or p > last + 1:
                length = last - start + least
                if item[start:start + length] == doc[start + shift:start + shift + length]:
                    heap.append((-length, start, start + shift))
                start = p
            last = p
    heapq.heapify(heap)
    in_item, in_doc, tiles = bytearray(len(item)), set(), []
    while heap:
        negative, p, q = heapq.heappop(heap)
        free = [not in_item[p + i] and (q + i) not in in_doc for i in range(-negative)]
        if all(free):
            tiles.append((p, q, -negative))
            for i in range(-negative):
                in_item[p + i] = 1
                in_doc.add(q + i)
            continue
        start = None
        for i, open_ in enumerate([*free, False]):
            if open_ and start is None:
                start = i
            elif not open_ and start is not None:
                if i - start >= least:
                    heapq.heappush(heap, (start - i, p + start, q + start))
                start = None
    return tiles


class _Items:
    """A block of benchmark items: their words and where each seed occurs in them."""

    def __init__(self, items: list[tuple[object, bytes]], least: int) -> None:
        self.ids = [i for i, _ in items]
        self.words = [t.split() for _, t in items]
        grams, owner, place = [], [], []
        for n, (_, text) in enumerate(items):
            found = gram_hashes(all_words(text)[2], least)
            grams.append(found)
            owner.append(np.full(len(found), n, dtype=np.int32))
            place.append(np.arange(len(found), dtype=np.int32))
        self.grams, self.owner, self.place = map(np.concatenate, (grams, owner, place))
        order = np.argsort(self.grams, kind="stable")
        self.grams, self.owner, self.place = (
            x[order] for x in (self.grams, self.owner, self.place))
        self.distinct = np.unique(self.grams)

    def seeds(self, gram: np.uint64) -> Iterator[tuple[int, int]]:
        at, end = np.searchsorted(self.grams, gram), np.searchsorted(self.grams, gram, "right")
        return zip(self.owner[at:end].tolist(), self.place[at:end].tolist())


def _blocks(items: DataFrame, least: int) -> Iterator[_Items]:
    block, size = [], 0
    for row in items.toLocalIterator():
        text = (row[1] or "").encode().lower()
        n = len(text.split())
        if n < least:
            continue
        block.append((row[0], text))
        size += n
        if size >= BLOCK_WORDS:
            yield _Items(block, least)
            block, size = [], 0
    if block:
        yield _Items(block, least)


def _compare(items: _Items, least: int, threshold: float, schema: pa.Schema):
    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_batches(batches, "text"):
            texts = [t.lower() for t in texts]
            _, _, _, hashes, first = joined_words(texts)
            grams = gram_hashes(hashes, least)
            at = np.minimum(np.searchsorted(items.distinct, grams), len(items.distinct) - 1)
            hits = np.flatnonzero(items.distinct[at] == grams)
            # A window that starts in one text and ends in the next is none.
            text_of = np.searchsorted(first, hits, "right") - 1
            whole = hits + least <= first[text_of + 1]
            found = defaultdict(lambda: defaultdict(list))
            for hit, n in zip(hits[whole].tolist(), text_of[whole].tolist()):
                for owner, place in items.seeds(grams[hit]):
                    found[n][owner].append((place, hit - int(first[n])))
            keys, out = rows.column("key"), []
            for n, owners in found.items():
                doc = texts[n].split()
                for owner, seeds in owners.items():
                    item = items.words[owner]
                    tiles = tile(item, doc, seeds, least)
                    covered = sum(t[2] for t in tiles)
                    if covered and covered >= threshold * len(item):
                        out.append((keys[n].as_py(), items.ids[owner], len(item), covered, [
                            {"item_start": p, "doc_start": q, "length": x}
                            for p, q, x in sorted(tiles)]))
            if out:
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return compare


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, least: int = SEED,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(key, item, item_words, covered, tiles)`` for each document whose tiles cover at least
    ``threshold`` of an item's words, in whatever order the passages stand.

    Words are runs without white space, A-Z lower-cased. Documents are compared where they are
    read: seeds of ``least`` words are looked up among those of a block of items, and only pairs
    that share one are tiled. No text is shuffled. Hashes only propose, words decide.

    Null and empty texts match nothing, and items shorter than ``least`` words are not searched
    for. Repeated documents or items give a row each; an empty table gives no rows; null ids are
    carried. Only the four named columns are read.
    """
    kinds = [docs.schema[key].dataType, benchmark.schema[item].dataType]
    span = T.StructType([T.StructField(n, T.LongType()) for n in ("item_start", "doc_start", "length")])
    names = [key, item if item != key else f"{item}_item", "item_words", "covered", "tiles"]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(
        names, [*kinds, T.LongType(), T.LongType(), T.ArrayType(span)])])
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    arrow = to_arrow_schema(schema)
    found = None
    for block in _blocks(benchmark.select(item, item_text), least):
        part = texts.mapInArrow(_compare(block, least, threshold, arrow), schema)
        found = part if found is None else stage(found).unionByName(stage(part))
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def clean_rows(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is not among the contaminated ones. Rows of one id go or stay
    together; a null id counts as an id."""
    bad = contaminated(docs, benchmark, key=key, **options).select(F.col(key).alias("bad")).distinct()
    return docs.alias("d").join(
        bad.alias("b"), F.expr(f"d.`{key}` <=> b.bad"), "left_anti")
