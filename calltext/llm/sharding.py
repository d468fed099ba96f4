"""Minimax contiguous partition: shards of nearly equal size from ordered atomic groups."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import in_order
from calltext.operators.staging import stage

# Groups are summed by blocks of neighbours in the order. The driver holds one row per block, and
# the sizes within the few blocks that a cut falls into.
GROUPS_PER_BLOCK = 4096
MOST_BLOCKS = 1 << 20
DIGITS = 7  # hexadecimal digits of the digest that name a block


class _Sizes:
    """Prefix sums over the ordered groups, exact within a block once it is loaded."""

    def __init__(self, blocks: list, load) -> None:
        self.numbers = [b["block"] for b in blocks]
        self.ends = np.cumsum([b["size"] for b in blocks]).tolist()
        self.total = self.ends[-1] if self.ends else 0
        self._load, self._known = load, {}

    def _inside(self, i: int) -> tuple[list[int], list[str]]:
        if i not in self._known:
            rows = sorted(self._load(self.numbers[i]))
            start = self.ends[i - 1] if i else 0
            sums = (np.cumsum([size for _, size in rows]) + start).tolist()
            self._known[i] = sums, [digest for digest, _ in rows]
        return self._known[i]

    def reach(self, limit: int) -> int:
        """The largest prefix sum, at a group's end, of at most ``limit``."""
        i = bisect_right(self.ends, limit)
        if i == len(self.ends):
            return self.total
        sums = self._inside(i)[0]
        j = bisect_right(sums, limit)
        return sums[j - 1] if j else (self.ends[i - 1] if i else 0)

    def first_after(self, cut: int) -> tuple[int, str] | None:
        """Block and digest of the group that starts at the prefix sum ``cut``."""
        i = bisect_right(self.ends, cut)
        if i == len(self.ends):
            return None
        if cut == (self.ends[i - 1] if i else 0):
            return self.numbers[i], ""
        sums, digests = self._inside(i)
        return self.numbers[i], digests[bisect_right(sums, cut)]


def _feasible(sizes: _Sizes, shards: int, capacity: int) -> bool:
    at = 0
    for _ in range(shards):
        at = sizes.reach(at + capacity)
    return at == sizes.total


def minimax_cuts(sizes: _Sizes, shards: int, largest: int) -> list[int]:
    """Prefix sums to cut at: no shard exceeds the smallest capacity for which greedy filling needs
    at most ``shards`` shards. Under that capacity each cut is the one nearest the even share of
    what is left, as plain greedy filling leaves the last shards empty when one group is huge."""
    low = max(-(-sizes.total // shards), largest)
    high = low + largest
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if _feasible(sizes, shards, middle) else (middle + 1, high)
    cuts, at = [], 0
    for left in range(shards, 1, -1):
        share = at + (sizes.total - at) // left
        down = sizes.reach(share)
        up = _next_end(sizes, share)
        # A shard takes at least one group while there are any.
        wanted = down if down > at and share - down <= up - share else up
        # What remains has to fit into the other shards.
        if wanted - at > low or not _rest_fits(sizes, wanted, left - 1, low):
            other = up if wanted == down else down
            if other - at <= low and _rest_fits(sizes, other, left - 1, low):
                wanted = other
            else:
                wanted = sizes.reach(at + low)
        cuts.append(wanted)
        at = wanted
    return cuts


def _next_end(sizes: _Sizes, limit: int) -> int:
    """The smallest prefix sum, at a group's end, of at least ``limit``."""
    i = bisect_right(sizes.ends, limit - 1)
    if i == len(sizes.ends):
        return sizes.total
    sums = sizes._inside(i)[0]
    return sums[bisect_right(sums, limit - 1)]


def _rest_fits(sizes: _Sizes, at: int, shards: int, capacity: int) -> bool:
    for _ in range(shards):
        at = sizes.reach(at + capacity)
    return at == sizes.total


def shard_by_bytes(docs: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id"
                   ) -> DataFrame:
    """``(key, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    Equal texts are one atomic group, a null text counting as the empty one. Groups are ordered by
    the SHA-256 of their text, rows within a group by key; a shard is a run of that order. Sizes are
    UTF-8 bytes plus one, and the smallest feasible capacity is found by binary search with a greedy
    check, then cut at. Law ``bytes``: one group larger than an even share makes its shard as large
    as that group, and the others share the rest evenly. An empty table gives no rows. Rows of a
    repeated key get slots of their own; a null key is ordered first. Only ``key`` and ``text`` are
    read, so other columns may have any names.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = in_order(docs.select(
        F.col(key).alias("_key"), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), F.sha2(content, 256).alias("_digest"),
    ), "_digest", "_key")
    groups = stage(rows.groupBy("_digest").agg(F.sum("size").alias("size")))
    n, largest = groups.agg(F.count("*"), F.max("size")).first()
    count = max(1, min(MOST_BLOCKS, n // GROUPS_PER_BLOCK))
    number = F.conv(F.substring("_digest", 1, DIGITS), 16, 10).cast("long")
    block = F.floor(number * count / F.lit(16 ** DIGITS)).cast("long")
    blocks = groups.groupBy(block.alias("block")).agg(F.sum("size").alias("size")).sort("block")
    sizes = _Sizes(blocks.collect(), lambda b: [
        tuple(r) for r in groups.filter(block == b).select("_digest", "size").collect()])
    starts = [sizes.first_after(c) for c in minimax_cuts(sizes, shards, largest)] if n else []
    placed = rows.withColumn("shard", _shard(block, starts))
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _shard(block: Column, starts: list) -> Column:
    shard = F.lit(0)
    for start in starts:
        if start is not None:
            number, digest = start
            after = (block > number) | ((block == number) & (F.col("_digest") >= digest))
            shard = shard + after.cast("int")
    return shard.cast("int")
