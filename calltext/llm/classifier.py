"""Quality classifier by co-training of a text view and a metadata view.

Every document is reduced to two short vectors where it is read. Each round scores all of them by both
views; the documents that one view is surest of, a share of all per class found by distributed
quantiles, become labels for the other view. A view is fitted to its labels by Newton steps whose
gradients and curvatures are sums over all documents, taken in the tasks and added up by Spark, so what
the driver holds is a few thousand numbers at every size. Sums are of whole multiples of a small unit
and so do not depend on the order in which tasks end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import gram_hashes, joined_words, text_batches
from calltext.operators.staging import stage

# Labelled documents that the fit may use. The others take part whole.
LABELLED = 4000
ROUNDS = 3
SHARE = 0.02  # of all documents, what each view labels for the other in a round
HELD_OUT = 0.25  # share of the labelled ones kept for calibration
KEEP_FROM = 0.5
TRIGRAMS = 1024
PROJECTED = 48  # numbers that the shares of the hashed trigrams are projected to
NAMES = 64
DENSE, LAYOUT = 7, 8
WIDTHS = (PROJECTED + DENSE, NAMES + LAYOUT)
# How freely the many hashed features may be used beside the few that describe the whole text.
HASHED = (PROJECTED, NAMES)
HASHED_EASE = 0.1
STEPS = 4  # Newton steps of each fit
PENALTY = 3e-2
LIMIT = 12.0  # logits beyond it are cut
BINS = 4096
UNIT = 2.0 ** -24
MIX = 0x9E3779B1


def _projection() -> np.ndarray:
    """Signs, drawn once and for all, that keep the distances of trigram shares."""
    signs = np.random.default_rng(0).integers(0, 2, (TRIGRAMS, PROJECTED)) * 2 - 1
    return (signs / PROJECTED ** 0.5).astype(np.float32)


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many different values each owner has."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=n)


def text_view(texts: list[bytes]) -> np.ndarray:
    """Projected roots of the shares of hashed byte trigrams; shares of distinct words and word pairs, also against the
    length; mean word length, symbols, length."""
    out = np.zeros((len(texts), TRIGRAMS), dtype=np.float32)
    for i, text in enumerate(texts):
        # Sums over pieces, so a very long text needs no more memory than its words.
        for at in range(0, len(text), 1 << 20):
            b = np.frombuffer(text, np.uint8, min(len(text) - at, (1 << 20) + 2), at).astype(np.uint32)
            if len(b) > 2:
                code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(MIX)
                out[i] += np.bincount(code >> np.uint32(22), minlength=TRIGRAMS)
        out[i] /= max(len(text) - 2, 1)
    _, starts, ends, hashes, first = joined_words(texts)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), count)
    some = np.maximum(count, 1)
    distinct = _distinct(owner, hashes, len(texts)) / some
    inside = owner[1:] == owner[:-1]  # no pair reaches over from the text before
    pairs = _distinct(owner[1:][inside], gram_hashes(hashes, 2)[inside], len(texts)) / some
    symbols = [sum(t.count(c) for c in b"#*$%&|<>") / max(len(t), 1) for t in texts]
    dense = np.column_stack((
        distinct, distinct * np.log1p(count) / 5, pairs, pairs < 0.5,
        np.bincount(owner, weights=ends - starts, minlength=len(texts)) / some / 10,
        np.minimum(symbols, 0.1) * 10, np.log1p(count) / 10))
    return np.concatenate((np.sqrt(out) @ _projection(), dense), axis=1).astype(np.float32)


def metadata_view(lang: list, source: list, texts: list[bytes]) -> np.ndarray:
    """Hashed language and source, and the page's layout: its length, its lines, their lengths, ends
    and repeats, stops and spaces."""
    out = np.zeros((len(texts), NAMES + LAYOUT), dtype=np.float32)
    for i, (names, text) in enumerate(zip(zip(lang, source), texts)):
        for place, name in enumerate(names):
            code = 0
            for b in repr((place, name)).encode():
                code = (code * 31 + b) & 0xFFFFFFFF
            out[i, (code * MIX & 0xFFFFFFFF) >> 26] = 1
        rows = text.split(b"\n")
        n, longest = len(rows), max(map(len, rows))
        stops = sum(r.rstrip().endswith((b".", b"!", b"?")) for r in rows)
        out[i, NAMES:] = (
            np.log1p(len(text)) / 10, np.log(n) / 5, np.log1p(len(text) / n) / 10,
            len(set(rows)) / n, longest / max(len(text), 1), stops / n,
            text.count(b". ") / max(len(text), 1) * 100, text.count(b" ") / max(len(text), 1) * 5)
    return out


@dataclass
class Linear:
    """Logistic regression over standardised features; the last weight is the offset."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        z = (x.astype(np.float64) - self.mean) * self.scale
        return np.concatenate((z, np.ones((len(z), 1))), axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.standard(x) @ self.weights, -LIMIT, LIMIT)


def class_sums(model: Linear, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For rows labelled 1 and rows labelled 0, others having -1: how many, and the sums of gradient and
    curvature of their loss. What a step needs of any number of rows."""
    out = []
    z = model.standard(x)
    p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -LIMIT, LIMIT)))
    for value in (1, 0):
        mine = y == value
        part, chance = z[mine], p[mine]
        curved = part.T @ (part * (chance * (1 - chance))[:, None])
        out += [[mine.sum()], part.T @ (chance - value), curved[np.triu_indices(len(curved))]]
    return np.concatenate(out)


def stepped(model: Linear, groups: list[np.ndarray]) -> Linear:
    """A Newton step on the ``class_sums`` of some groups of rows. Groups weigh the same, and within
    each both classes do, so that neither many pseudo-labels nor a frequent class drown the others."""
    n = len(model.weights)
    m = n * (n + 1) // 2
    gradient, curvature = np.zeros(n), np.zeros((n, n))
    groups = [g for g in groups if g[0] and g[1 + n + m]]
    for sums in groups:
        for part in (sums[:1 + n + m], sums[1 + n + m:]):
            weight = 0.5 / part[0] / len(groups)
            upper = np.zeros((n, n))
            upper[np.triu_indices(n)] = part[1 + n:]
            gradient += weight * part[1:1 + n]
            curvature += weight * (upper + np.triu(upper, 1).T)
    penalty = np.full(n, PENALTY)
    penalty[-1] = 1e-6
    move = np.linalg.solve(curvature + np.diag(penalty), gradient + penalty * model.weights)
    size = np.abs(move).max()
    return Linear(model.mean, model.scale, model.weights - move * min(1, 3 / max(size, 1e-12)))


def _calibrated(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and offset that make logits of one view probabilities."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(slope * logits + offset)))
        g = np.array([(p - y) @ logits + 1e-2 * (slope - 1), (p - y).sum()])
        w = p * (1 - p) + 1e-6
        h = np.array([[(w * logits * logits).sum() + 1e-2, (w * logits).sum()],
                      [(w * logits).sum(), w.sum() + 1e-6]])
        slope, offset = np.array([slope, offset]) - np.linalg.solve(h, g)
        slope, offset = float(np.clip(slope, 0, 20)), float(np.clip(offset, -20, 20))
    return slope, offset


@dataclass
class CoTrained:
    """Two views with their calibration and their say in the combination."""

    views: tuple[Linear, Linear]
    scales: tuple[tuple[float, float], tuple[float, float]]
    say: tuple[float, float]

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, ...]:
        parts = [s * v.logit(x) + o for v, (s, o), x in zip(
            self.views, self.scales, (text, metadata))]
        both = self.say[0] * parts[0] + self.say[1] * parts[1]
        return tuple(1 / (1 + np.exp(-z)) for z in (*parts, both))


# A round: the two views as they were, and the logits below and above which each gives labels.
Round = tuple[tuple[Linear, Linear], tuple[tuple[float, float], tuple[float, float]]]


def given_labels(rounds: list[Round], views: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The label that each view has been given by the other in the rounds so far, the first one
    holding; -1 where it has none."""
    labels = [np.full(len(x), -1, dtype=np.int8) for x in views]
    for models, limits in rounds:
        for own, (model, (low, high)) in enumerate(zip(models, limits)):
            z, taker = model.logit(views[own]), labels[1 - own]
            free = taker < 0
            taker[free & (z >= high)] = 1
            taker[free & (z <= low)] = 0
    return labels


def confidence_bins(rounds: list[Round], models: tuple[Linear, Linear],
                    views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each view the numbers of documents by logit, of those that it has not labelled yet."""
    labels = given_labels(rounds, views)
    out = []
    for own, model in enumerate(models):
        z = model.logit(views[own][labels[1 - own] < 0])
        out.append(np.bincount(((z + LIMIT) * (BINS / (2 * LIMIT))).astype(int).clip(0, BINS - 1),
                               minlength=BINS))
    return np.concatenate(out)


def limits_of(bins: np.ndarray, wanted: float, prior: float) -> tuple[float, float]:
    """The logits that part off ``wanted`` documents, ``prior`` of them above. Documents of one bin go
    together: the last one that is begun is taken whole. No label goes against its own logit."""
    width = 2 * LIMIT / BINS
    above = np.cumsum(bins[::-1]) - bins[::-1]
    below = np.cumsum(bins) - bins
    highest = (above < wanted * prior).sum()
    lowest = (below < wanted * (1 - prior)).sum()
    high = LIMIT - highest * width if highest else np.inf
    low = -LIMIT + lowest * width if lowest else -np.inf
    return min(low, -width), max(high, width)


def co_train(views: list[np.ndarray], y: np.ndarray, total: Callable[[Callable], np.ndarray]
             ) -> CoTrained | None:
    """Fit both views on labelled rows and, over rounds, on the labels that each gets from the other,
    then calibrate on held-out labelled rows. ``total(f)`` is the sum of ``f(views)`` over all
    documents. The calibrated logits are added in proportion to how much better than chance each view
    is on the held-out rows. None without two classes."""
    held = np.arange(len(y)) % round(1 / HELD_OUT) == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return None
    moments = total(lambda v: np.concatenate(
        [np.array([len(v[0])]), *(m for x in v for m in (
            x.sum(axis=0, dtype=np.float64), (x.astype(np.float64) ** 2).sum(axis=0)))]))
    documents, at, models = moments[0], 1, []
    for width, hashed in zip(WIDTHS, HASHED):
        mean = moments[at:at + width] / documents
        square = moments[at + width:at + 2 * width] / documents
        scale = 1 / (np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-3)
        scale[:hashed] *= HASHED_EASE
        models.append(Linear(mean, scale, np.zeros(width + 1)))
        at += 2 * width
    known = [v[~held] for v in views]
    truth, prior = y[~held], y.mean()
    for _ in range(2 * STEPS):
        models = [stepped(m, [class_sums(m, x, truth)]) for m, x in zip(models, known)]
    rounds: list[Round] = []
    for _ in range(ROUNDS):
        now = tuple(models)
        bins = total(lambda v, now=now: confidence_bins(rounds, now, v))
        rounds.append((now, tuple(limits_of(b, SHARE * documents, prior)
                                  for b in (bins[:BINS], bins[BINS:]))))
        for _ in range(STEPS):
            now = tuple(models)
            sums = total(lambda v, now=now: np.concatenate([
                class_sums(m, x, z) for m, x, z in zip(now, v, given_labels(rounds, v))]))
            cut = len(class_sums(now[0], known[0][:0], truth[:0]))
            models = [stepped(m, [class_sums(m, x, truth), part])
                      for m, x, part in zip(now, known, (sums[:cut], sums[cut:]))]
    logits = [m.logit(v[held]) for m, v in zip(models, views)]
    scales = [_calibrated(z, y[held]) for z in logits]
    chance = -(prior * np.log(prior) + (1 - prior) * np.log(1 - prior))
    gain = []
    for z, (s, o) in zip(logits, scales):
        p = np.clip(1 / (1 + np.exp(-(s * z + o))), 1e-6, 1 - 1e-6)
        loss = -(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)).mean()
        gain.append(max(chance - loss, 0.0) + 1e-6)
    return CoTrained(tuple(models), tuple(scales), tuple(g / max(gain) for g in gain))


def _reduced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both views of each row as bytes, in place of its text."""
    for part, texts in text_batches(batches, "text"):
        a = text_view(texts)
        b = metadata_view(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts)
        rest = [c for c in part.schema.names if c not in ("text", "lang", "source")]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in rest), pa.array([x.tobytes() for x in a], pa.binary()),
             pa.array([x.tobytes() for x in b], pa.binary())], [*rest, "a", "b"])


def _views(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(part.column(c).to_pylist()), np.float32).reshape(-1, width)
                 for c, width in zip("ab", WIDTHS))


def _total(reduced: DataFrame) -> Callable[[Callable], np.ndarray]:
    """Sums of a function of the views over all rows: each task adds up its own, Spark adds up those
    of the tasks, place by place."""
    def total(of: Callable) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = 0
            for part in batches:
                if part.num_rows:
                    sums = sums + np.rint(of(_views(part)) / UNIT)
            if np.ndim(sums):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(sums)), pa.int64()), pa.array(sums, pa.float64())],
                    ["place", "units"])

        found = reduced.mapInArrow(run, "place long, units double").groupBy("place").agg(
            F.sum(F.col("units").cast("decimal(38,0)")).cast("double").alias("units")).collect()
        out = np.zeros(len(found))
        for place, units in found:
            out[place] = units * UNIT
        return out

    return total


def _scoring(model: CoTrained | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if model is None or not part.num_rows:
                scores = [np.full(part.num_rows, 1.0)] * 3
            else:
                scores = model.scores(*_views(part))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *(pa.array(s.astype(np.float64)) for s in scores)],
                ["key", "text_score", "metadata_score", "score"])

    return run


def scored(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``(key, text_score, metadata_score, score, kept)`` for every row of ``docs``: the calibrated
    probability of ``label`` by each view and by both, and whether the last is at least
    ``KEEP_FROM``.

    The fit uses at most ``LABELLED`` labelled documents, those with the least hash of their key, the
    same ones in each run; of rows with one key, one takes part. The labels that the views exchange
    go to all documents, labelled or not, as labels of ``labels`` are not looked at there.

    Null texts, languages and sources are values like any other, an empty text has no features; a text
    of any length is read whole, in pieces. Rows with a null label or key do not take part as labelled
    ones. Without labels of both kinds there is nothing to learn, and every row gets score 1. Repeated
    rows get equal scores; an empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in (
        (key, "key"), (text, "text"), (lang, "lang"), (source, "source"))))
    kind = docs.schema[key].dataType.simpleString()
    reduced = stage(rows.mapInArrow(_reduced, f"key {kind}, a binary, b binary"))
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y")).filter(
        "key IS NOT NULL AND y IS NOT NULL").groupBy("key").agg(F.max("y").alias("y"))
    picked = known.orderBy(F.xxhash64("key"), "key").limit(LABELLED)
    # Bounded by the limit above, as each key is reduced to one row.
    found = reduced.join(F.broadcast(picked), "key").groupBy("key").agg(
        F.min(F.struct("a", "b", "y")).alias("r")).select("key", "r.*").collect()
    found.sort(key=lambda r: (str(r["key"])))
    views = [np.frombuffer(b"".join(r[c] for r in found), np.float32).reshape(-1, width)
             for c, width in zip("ab", WIDTHS)]
    y = np.array([float(r["y"] > 0) for r in found])
    model = co_train(views, y, _total(reduced)) if len(y) else None
    return reduced.mapInArrow(
        _scoring(model), f"key {kind}, text_score double, metadata_score double, score double"
    ).withColumn("kept", F.col("score") >= KEEP_FROM).withColumnRenamed("key", key)
