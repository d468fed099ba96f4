"""A manifest of a data set: a hash tree over its rows, with proofs and versions.

The rows of a group are the leaves of its tree, in key order; the roots of the groups are the leaves
of a last tree, whose root stands for the whole set. The tree is persistent. A changed leaf makes a
version that shares every node but the ancestors of that leaf, and these are copied, never written
over. Nodes are kept in aligned blocks of ``2 ** BITS`` neighbours: a version copies the ancestors
inside its own block first and goes on through the blocks above, whose shared nodes reach it as the
path of its block. So no task holds more than one block and what hangs on it.

* Null keys come first, equal keys are in the order of their digests, equal rows are leaves of
  their own. A null group is a group, the first one.
* A null value is written ``-``, an empty text ``0:``. Texts are hashed whole where they are read,
  in memory that follows the text.
* An empty table has no root and gives no rows. Columns that are not named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import in_order
from calltext.operators.staging import broadcast_if_small, stage

# A block holds 1,024 nodes: some 100 kB, and ten levels of the tree to a pass.
BITS = 10


def digest(text: str) -> str:
    """Lowercase hex of the SHA-256 of a text."""
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as the leaves write it: its length in bytes, a colon and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


# -- one block, in a task ----------------------------------------------------------------------------

def levels(nodes: list[str], height: int) -> list[list[str]]:
    """The nodes of a block and of the ``height`` levels above them; the last node of an odd number
    is hashed alone."""
    out = [nodes]
    for _ in range(height):
        below = out[-1]
        out.append([digest("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level of a block the side and digest of the other node of the pair, or ``-`` and
    nothing."""
    path = []
    for nodes in tree[:-1]:
        other = at ^ 1
        path.append(("L" if other < at else "R", nodes[other]) if other < len(nodes) else ("-", ""))
        at >>= 1
    return path


def copied(node: str, path: Sequence[tuple[str, str]]) -> Iterator[str]:
    """The ancestors that a version with another ``node`` needs, from below to the root."""
    for side, other in path:
        node = digest(other + node if side == "L" else node + other)
        yield node


def _text(path: Sequence[tuple[str, str]]) -> str:
    return ",".join(side + other for side, other in path)


def _path(text: str) -> list[tuple[str, str]]:
    return [(step[:1], step[1:]) for step in text.split(",")] if text else []


def _sorted(table: pa.Table, *columns: str) -> list[list]:
    table = table.sort_by("at")
    return [table.column(c).to_pylist() for c in columns]


# -- trees of any size ------------------------------------------------------------------------------

def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    """The top of each block of ``nodes (g, at, digest, height)``; ``height`` is what is left above
    a node, and with it goes what is left above its block."""
    def fold(table: pa.Table) -> pa.Table:
        group, at, digests, height = _sorted(table, "g", "at", "digest", "height")
        steps = min(bits, height[0])
        top = levels(digests, steps)[-1][0]
        return pa.table({"g": [group[0]], "at": [at[0] >> bits], "digest": [top],
                         "height": pa.array([height[0] - steps], pa.int32())})

    return nodes.groupBy("g", F.shiftright("at", bits).alias("b")).applyInArrow(
        fold, "g long, at long, digest string, height int")


def _paths(nodes: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """``(g, at, path, root)`` of each node, from ``above``, the same of each block."""
    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        group, at, digests, height = _sorted(left, "g", "at", "digest", "height")
        tree = levels(digests, min(bits, height[0]))
        upper, root = right.column("path")[0].as_py(), right.column("root")[0].as_py()
        paths = [",".join(filter(None, (_text(siblings(tree, i)), upper)))
                 for i in range(len(at))]
        return pa.table({"g": group, "at": at, "path": paths, "root": [root] * len(at)})

    return nodes.groupBy("g", F.shiftright("at", bits).alias("b")).cogroup(
        above.groupBy("g", F.col("at").alias("b"))
    ).applyInArrow(walk, "g long, at long, path string, root string")


def _block_paths(nodes: DataFrame, bits: int) -> DataFrame:
    """``(g, at, path, root)`` of each block of ``nodes``, to the root of its group. Each round is
    ``2 ** bits`` times smaller than the one before."""
    blocks = stage(_blocks(nodes, bits))
    if not blocks.filter("height > 0").limit(1).count():
        return blocks.select("g", "at", F.lit("").alias("path"), F.col("digest").alias("root"))
    return stage(_paths(blocks, _block_paths(blocks, bits), bits))


def _height(count: Column) -> Column:
    """Levels above ``count`` leaves: the binary digits of the last leaf's place."""
    place = F.bin(count - 1)
    return F.when(count > 1, F.length(place)).otherwise(F.lit(0)).cast("int")


class Manifest:
    """The tree over ``rows (grp, key, digest, version)``: ``version`` is the digest of the row as it
    is said to be now, equal to ``digest`` where nothing changed."""

    def __init__(self, rows: DataFrame, bits: int = BITS):
        self.bits = bits
        # Equal rows are told apart by their place in the input, so that very many of them do not
        # meet in one partition; which of them comes first makes no difference.
        tie = stage(rows.select("grp", "key", "digest", "version")
                    .withColumn("tie", F.monotonically_increasing_id()))
        ranked = in_order(tie, "grp", "key", "digest", "tie")
        groups = in_order(ranked.groupBy("grp").agg(
            F.min("rank").alias("first"), F.count("*").alias("n")), "grp", rank="g")
        groups = groups.withColumn("height", _height(F.col("n")))
        self.groups = stage(groups)
        self.leaves = stage(
            ranked.alias("r").join(broadcast_if_small(self.groups).alias("q"),
                                   F.expr("r.grp <=> q.grp"))
            .select("r.grp", "key", "digest", "version", "g", "height",
                    (F.col("rank") - F.col("first")).alias("at")))
        inner = _block_paths(self.leaves, bits)
        count = self.groups.count()
        height = max(count - 1, 0).bit_length()
        # The roots of the groups are the leaves of the last tree, which is group 0 of its own.
        subroots = stage(inner.groupBy("g").agg(F.min("root").alias("digest")).select(
            F.lit(0).cast("long").alias("g"), F.col("g").alias("at"), "digest",
            F.lit(height).alias("height")))
        outer = stage(_paths(subroots, _block_paths(subroots, bits), bits).select(
            F.col("at").alias("g"), F.col("path").alias("last"), F.col("root").alias("top")))
        self.blocks = stage(inner.join(broadcast_if_small(outer), "g").select(
            "g", "at", F.concat_ws(",", F.nullif("path", F.lit("")),
                                   F.nullif("last", F.lit(""))).alias("path"),
            F.col("root").alias("subroot"), F.col("top").alias("root")))

    def _per_block(self, work, extra: dict[str, str]) -> DataFrame:
        """Rows ``(grp, key, digest, version, *extra)`` of each block of leaves. ``work(digests,
        versions, tree, above)`` gives which row each one is of and the extra columns; ``above`` is
        the path from the top of the block to the root."""
        bits, kinds = self.bits, self.leaves.schema
        shown = ", ".join([*(f"{c} {kinds[c].dataType.simpleString()}"
                             for c in ("grp", "key", "digest", "version")),
                           "subroot string", "root string",
                           *(f"{name} {kind}" for name, kind in extra.items())])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            left = left.sort_by("at")
            digests, versions = (left.column(c).to_pylist() for c in ("digest", "version"))
            tree = levels(digests, min(bits, left.column("height")[0].as_py()))
            path, subroot, root = (right.column(c)[0].as_py() for c in ("path", "subroot", "root"))
            chosen, columns = work(digests, versions, tree, _path(path))
            out = left.take(pa.array(chosen, pa.int64())).select(["grp", "key", "digest", "version"])
            for name, value in (("subroot", subroot), ("root", root)):
                out = out.append_column(name, pa.array([value] * len(chosen), pa.string()))
            for (name, kind), values in zip(extra.items(), columns):
                arrow = pa.int32() if kind == "int" else pa.string()
                out = out.append_column(name, pa.array(values, arrow))
            return out

        return self.leaves.groupBy("g", F.shiftright("at", bits).alias("b")).cogroup(
            self.blocks.groupBy("g", F.col("at").alias("b"))).applyInArrow(run, shown)

    def versions(self) -> DataFrame:
        """``(grp, key, level, node)``: the nodes that the version of each changed row has to itself,
        level 0 being the leaf. All other nodes are shared."""
        def work(digests, versions, tree, above):
            rows, depth, nodes = [], [], []
            for i, (old, new) in enumerate(zip(digests, versions)):
                if new != old:
                    own = [new, *copied(new, siblings(tree, i) + above)]
                    rows += [i] * len(own)
                    depth += range(len(own))
                    nodes += own
            return rows, (depth, nodes)

        return self._per_block(work, {"level": "int", "node": "string"}).select(
            "grp", "key", "level", "node")

    def proofs(self) -> DataFrame:
        """``(grp, key, leaf, subroot, root, proof_sha256, folded_root)`` of each row. The proof is
        the row's siblings from below to the root; the folded root is that of the row's version, or
        what the row itself and its proof give."""
        def work(digests, versions, tree, above):
            beyond = "".join(other for _, other in above)
            proofs, folded = [], []
            for i, node in enumerate(versions):
                path = siblings(tree, i)
                proofs.append(digest("".join([*(other for _, other in path), beyond])))
                for node in copied(node, path + above):
                    pass
                folded.append(node)
            return range(len(digests)), (proofs, folded)

        return self._per_block(
            work, {"proof_sha256": "string", "folded_root": "string"},
        ).withColumnRenamed("digest", "leaf").drop("version")


def tampered(docs: DataFrame, key: str = "doc_id", group: str = "lang", count: str = "n_chars",
             text: str = "text", source: str = "source", every: int = 7) -> DataFrame:
    """Rows for ``Manifest`` from documents of which some are said to have one character more:
    those whose key has a CRC-32 that ``every`` divides. A null count or key stays."""
    def row(n: Column) -> Column:
        return leaf(F.col(key), F.col(source), F.col(group), n, F.col(text))

    chosen = F.crc32(F.col(key).cast("string")) % every == 0
    more = (F.col(count).cast("decimal(20,0)") + 1).cast("string")
    original = row(F.col(count))
    return docs.select(
        F.col(group).alias("grp"), F.col(key).alias("key"), original.alias("digest"),
        F.when(chosen & F.col(count).isNotNull(), row(more)).alias("version"),
    ).withColumn("version", F.coalesce("version", "digest"))
