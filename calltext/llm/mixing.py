"""Mixing sources to target weights over training time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import in_order, parallelism, word_count
from calltext.operators.staging import stage

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Weight of a source while training runs from 0 to 1, as (time, factor) corners of a line. Sources
# take the schedules in turn, like the weights: even, rising, falling.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.5), (0.5, 0.75), (1.0, 0.75)),
)


def source_targets(
    docs: DataFrame, share: float = 1.0, weights: Sequence[float] = WEIGHTS,
    most: float = MOST_REPEATS, source: str = "source", text: str = "text",
) -> DataFrame:
    """``(_source, _turn, source_size, target)`` for each source of ``docs``.

    Sources by code point, null last, take the weights in turn. The mix has ``share`` of all words;
    a target stops at ``most`` times its source's size and the excess goes to the others by weight,
    again until none is above. Sizes count words; a source without words has target 0.
    """
    totals = docs.groupBy(F.col(source).alias("_source")).agg(
        F.sum(word_count(F.col(text))).alias("source_size"))
    return _filled(totals, share, weights, most)


def _filled(totals: DataFrame, share: float, weights: Sequence[float], most: float) -> DataFrame:
    ranked = in_order(
        totals.withColumn("_last", F.col("_source").isNull()), "_last", "_source", rank="_rank")
    turn = (F.col("_rank") % len(weights)).cast("int")
    sources = stage(
        ranked.withColumn("_turn", turn)
        .withColumn("_weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), F.col("_turn")))
        .withColumn("_most", F.col("source_size") * F.lit(float(most))).drop("_last", "_rank"))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    # Sources whose cap is reached at this level of words per weight stay at the cap; the level
    # only rises, so each round caps more of them until none is above.
    level, capped = 0.0, -1
    while True:
        full = F.col("_most") <= F.col("_weight") * level
        n, held, weight = sources.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))).first()
        if n == capped or weight == 0.0:
            break
        level, capped = (total - held) / weight, n
    target = F.least(F.col("_most"), F.col("_weight") * F.lit(float(level)))
    return sources.select("_source", "_turn", "source_size", target.alias("target"))


def _time_of(share, schedules):
    """The training time at which a source has used ``share`` of its demand: the schedule's
    integral, quadratic between corners, inverted."""
    cases = None
    for turn, corners in enumerate(schedules):
        area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(corners, corners[1:])]
        total, before, pick = sum(area), 0.0, None
        for ((t0, w0), (t1, w1)), part in zip(zip(corners, corners[1:]), area):
            slope = (w1 - w0) / (t1 - t0)
            rest = F.greatest(share * total - F.lit(before), F.lit(0.0))
            # w0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0.
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
            x = F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(w0) + root))
            time = F.least(F.lit(t0) + x, F.lit(t1))
            hit = share * total <= before + part
            pick = F.when(hit, time) if pick is None else pick.when(hit, time)
            before += part
        pick = pick.otherwise(F.lit(corners[-1][0]))
        here = F.col("_turn") == turn
        cases = F.when(here, pick) if cases is None else cases.when(here, pick)
    return cases


def _row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))


def curriculum(
    docs: DataFrame, share: float = 1.0, weights: Sequence[float] = WEIGHTS,
    most: int = MOST_REPEATS, schedules=SCHEDULES, source: str = "source", text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row for each row of ``docs``: ``_key``, ``size``, ``source_size``, ``target``, ``passes``
    (how often the mix takes it) and ``positions`` (when, between 0 and 1).

    Documents of a source line up in an order drawn from their key. Their running word counts, laid
    over as many passes as the target needs, are the source's cumulative demand; the integral of
    its weight schedule, inverted, turns the middle of each taken document into its position. A
    document is taken in a pass when its middle lies below the target, so a source misses its
    target by at most half a document. ``in_training_order`` sorts the documents by position.

    A document without words is taken in each pass that reaches its place. Equal keys share a draw
    and are all placed; null sources are a source of their own; a source without words is left out
    of the mix; an empty table gives no rows. Texts are measured and hashed where they are read, whole
    ones of any length, and do not travel. ``_hash`` is of all columns, so rows that agree in key and
    hash are equal and may swap their places. Other columns are hashed and no more.
    """
    # Measured once, as the exchange by range looks at its rows twice.
    drawn = stage(docs.select(
        F.col(f"`{key}`").alias("_key"), _row_hash(docs).alias("_hash"),
        F.col(f"`{source}`").alias("_source"), word_count(F.col(f"`{text}`")).alias("size"),
        F.md5(F.col(f"`{key}`").cast("string").cast("binary")).alias("_draw"),
        F.monotonically_increasing_id().alias("_tie")))
    line = ("_source", "_draw", "_key", "_hash", "_tie")
    slices = stage(
        drawn.repartitionByRange(parallelism(docs), *line).sortWithinPartitions(*line)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()))
    targets = _filled(
        slices.groupBy("_source").agg(F.sum("size").alias("source_size")), share, weights, most)
    running = slices.withColumn("_within", F.expr(
        "sum(size) OVER (PARTITION BY _source, _slice ORDER BY _place"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    # One row per source and slice of the exchange.
    parts = slices.groupBy("_source", "_slice").agg(F.sum("size").alias("_part")).withColumn(
        "_before", F.expr("sum(_part) OVER (PARTITION BY _source ORDER BY _slice) - _part"))
    same = running["_source"].eqNullSafe(parts["_source"]) & (running["_slice"] == parts["_slice"])
    lined = running.join(parts, same).select(
        "_key", "_hash", "_draw", running["_source"], "size",
        (F.col("_before") + F.col("_within") - F.col("size") / 2).alias("_middle"))
    sized = lined.join(targets, lined["_source"].eqNullSafe(targets["_source"]))
    left = (F.col("target") - F.col("_middle")) / F.col("source_size")
    passes = F.when(F.col("source_size") > 0, F.least(F.greatest(F.ceil(left), F.lit(0)),
                                                     F.lit(int(most)))).otherwise(0)
    counted = sized.withColumn("passes", passes.cast("int"))
    positions = [
        F.when(F.col("passes") > i, _time_of(
            (F.col("_middle") + i * F.col("source_size")) / F.col("target"), schedules))
        for i in range(int(most))]
    return counted.select(
        "_key", "_hash", "_draw", "size", "source_size", "target", "passes",
        F.slice(F.array(*positions), F.lit(1), F.col("passes")).alias("positions"))


def in_place(plan: DataFrame) -> DataFrame:
    """The rows of ``curriculum`` with ``first_position`` and ``last_position`` and with ``first_rank``,
    the place among all takings, from 0, at which training meets the document first. Takings are
    range-sorted by position; documents that are not taken have NULL in all three."""
    takings = plan.select(
        "*", F.posexplode_outer("positions").alias("_pass", "_position")
    ).withColumn("_out", F.col("_position").isNull())
    ranked = in_order(takings, "_out", "_position", "_draw", "_key", "_hash", "_pass")
    rank = F.when(~F.col("_out"), F.col("rank"))
    return ranked.filter("_out OR _pass = 0").select(
        *plan.columns, F.col("_position").alias("first_position"),
        F.get("positions", F.size("positions") - 1).alias("last_position"), rank.alias("first_rank"))


def in_training_order(
    docs: DataFrame, plan: DataFrame, key: str = "doc_id",
) -> DataFrame:
    """The rows of ``docs`` that ``plan``, its ``curriculum``, takes, as often as it does, range-sorted
    by position. Equal rows are reduced to one in each task first and meet their places in a join,
    so that many copies of a row are split like any frequent key. Null keys meet null keys; an empty
    table gives no rows, and columns may have any names but those of this join, which begin with two
    underscores and ``row``."""
    taken = plan.filter("passes > 0").select("_key", "_hash", F.explode("positions").alias("_place"))
    content = docs.select(
        F.col(f"`{key}`").alias("__row_key"), _row_hash(docs).alias("__row_hash"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    content = stage(content.groupBy("__row_key", "__row_hash").agg(
        F.any_value("__row").alias("__row"))).alias("d")
    same = F.expr("d.__row_key <=> p._key AND d.__row_hash = p._hash")
    found = content.join(taken.alias("p"), same).select(
        "__row", "__row_hash", F.col("_place").alias("__row_place"))
    return found.sort("__row_place", "__row_hash").select("__row.*")
