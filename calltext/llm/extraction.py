"""The main text of web pages, by a recurrent labeller of their blocks.

Each page is read as its sequence of blocks (``markup``). A bidirectional LSTM (``recurrent``) sees the
whole sequence, so what a block is judged by includes all that stands before and after it. Blocks
labelled as article are joined in page order.

The labeller is trained here, on pages built from the words of a bounded sample of the given ones
(``layouts``), whose labels are known, and on those given pages that mark one article themselves.

* A null or empty page, one without text, and one in which no block is part of an article have an
  empty text. Markup that is broken is read as far as it goes. A page of any length is read whole; what
  a task holds follows its longest page.
* Repeated rows give repeated results; the sample takes rows in the order of a hash of their markup,
  so ties are equal pages. Columns of any name are left alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from calltext.llm import recurrent
from calltext.llm.common import text_batches
from calltext.llm.layouts import Layouts
from calltext.llm.markup import Block, blocks, features

# Given pages the labeller learns from, the pages made of their words, and the longest page taken.
SAMPLE = 200
MADE = 700
LONGEST = 400
_KEPT = 1 << 15  # of a sampled page, letters: the fit's bound on one page

# Elements in which a page marks its article, and those that are no part of one.
_MARKED = ("article", "main")


def own_labels(html: str) -> tuple[list[Block], list[bool]] | None:
    """The blocks of a page that marks exactly one article, and which are within it; else nothing."""
    low = html.lower()
    for name in _MARKED:
        if low.count(f"<{name}>") + low.count(f"<{name} ") == 1 and low.count(f"</{name}>") == 1:
            start = low.index(f"<{name}")
            end = low.index(f"</{name}>")
            before = len(blocks(html[:start]))
            inside = blocks(html)
            within = len(blocks(html[:end])) - before
            truth = [before <= i < before + within for i in range(len(inside))]
            return inside, truth
    return None


def learn(pages: list[str], made: int = MADE, seed: int = 1, rounds: int = 14) -> recurrent.Weights:
    """Weights learnt from given pages and from ``made`` pages of their words."""
    sequences, truths, sentences = [], [], []
    for html in pages:
        marked = own_labels(html)
        found = marked[0] if marked else blocks(html)
        sentences += [s for b in found for s in b.text.replace(". ", ".\n").split("\n")]
        if marked and 0 < len(found) <= LONGEST:
            sequences.append(features(found))
            truths.append(np.array(marked[1]))
    source = Layouts(sentences, seed)
    for _ in range(made):
        html, labels = source.page()
        found = blocks(html)
        if len(found) == len(labels) and 0 < len(found) <= LONGEST:
            sequences.append(features(found))
            truths.append(np.array(labels))
    return recurrent.fit(sequences, truths, rounds=rounds, seed=seed)


def fitted(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> recurrent.Weights:
    """Weights learnt from at most ``sample`` pages, those with the least hashes of their markup."""
    rows = (
        pages.select(F.substring(F.col(f"`{html}`"), 1, _KEPT).alias("html"),
                     F.xxhash64(f"`{html}`").alias("order"))
        .filter("html IS NOT NULL").orderBy("order", "html").limit(sample).toArrow())
    return learn(rows.column("html").to_pylist())


def main_text(found: list[Block], chances: np.ndarray) -> str:
    return "\n".join(b.text for b, chance in zip(found, chances) if chance > 0.5)


def main_texts(pages: DataFrame, weights: recurrent.Weights, html: str = "html",
               *carry: str) -> DataFrame:
    """``carry`` and ``text, n_chars``: the main text of every page."""
    fields = [pages.schema[c] for c in carry]
    schema = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in text_batches(batches, "__html"):
            found = [blocks(source.decode()) for source in sources]
            chances = recurrent.scores(weights, [features(f) for f in found])
            texts = [main_text(f, c) for f, c in zip(found, chances)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    rows = pages.select(*(F.col(f"`{c}`") for c in carry), F.col(f"`{html}`").alias("__html"))
    return rows.mapInArrow(work, schema)
