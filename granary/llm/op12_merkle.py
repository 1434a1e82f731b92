"""A Merkle manifest of a table: one hash tree per group, and a tree over the groups.

Parents keep a copy of their hash state as it was before each child slot. To see what a
changed leaf does to the root, the state before its slot is resumed, takes the replacement
and the siblings to its right, and gives the new parent; siblings to its left are never
hashed again.

Leaves are numbered by a range partitioning, then cut into blocks of consecutive ones. A
block holds about a thousand nodes whatever the size of its group. Tops of blocks are the
nodes of the next round, until every group has one node left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import texts

# Nodes of a block at most.
BLOCK_NODES = 1024

# A step of a path: the place among the children of the parent, and the other children.
PATH = "array<struct<slot: int, siblings: array<string>>>"
STEP = pa.struct([("slot", pa.int32()), ("siblings", pa.list_(pa.string()))])


def leaf_digest(*values: Column) -> Column:
    """Hash of values, each led by its length in bytes, or `-` where it is null."""
    cells = [value.cast("string") for value in values]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]), 256
    )


def proof_digest(path: Column) -> Column:
    """Hash of all siblings along a path, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: step["siblings"])), ""), 256)


class Levels:
    """The levels above consecutive nodes, the first of which opens a run of siblings."""

    def __init__(self, nodes: Sequence[str], count: int, fanout: int):
        self.fanout = fanout
        self.nodes = [[node.encode() for node in nodes]]
        self.before = []
        for _ in range(count):
            below, before, above = self.nodes[-1], [], []
            for low in range(0, len(below), fanout):
                state = hashlib.sha256()
                for child in below[low : low + fanout]:
                    before.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.before.append(before)
            self.nodes.append(above)

    @property
    def top(self) -> str:
        return self.nodes[-1][0].decode()

    def path(self, place: int) -> list[dict]:
        """The siblings that a node and its ancestors have, level by level."""
        steps = []
        for level in self.nodes[:-1]:
            low = place - place % self.fanout
            run = [child.decode() for child in level[low : low + self.fanout]]
            steps.append({"slot": place - low, "siblings": run[: place - low] + run[place - low + 1 :]})
            place //= self.fanout
        return steps

    def folded(self, place: int, replacement: str) -> str:
        """The top with another node at a place."""
        node = replacement.encode()
        for level, before in zip(self.nodes, self.before):
            state = before[place].copy()
            state.update(node)
            end = place - place % self.fanout + self.fanout
            state.update(b"".join(level[place + 1 : end]))
            node, place = state.hexdigest().encode(), place // self.fanout
        return node.decode()


class Climb:
    """Folds the tops of one block along the path that all its nodes share."""

    def __init__(self, path: list[dict]):
        self.steps = [
            (hashlib.sha256("".join(step["siblings"][: step["slot"]]).encode()), "".join(step["siblings"][step["slot"] :]).encode())
            for step in path
        ]
        self.known: dict[str, str] = {}

    def folded(self, node: str) -> str:
        """The root over a node; blocks give few different ones, so they are remembered."""
        if node not in self.known:
            found = node.encode()
            for before, right in self.steps:
                state = before.copy()
                state.update(found)
                state.update(right)
                found = state.hexdigest().encode()
            self.known[node] = found.decode()
        return self.known[node]


@dataclass(frozen=True)
class Shape:
    """Children of a parent, and the levels a block spans; it holds `fanout ** span` nodes."""

    fanout: int
    span: int

    @classmethod
    def of(cls, fanout: int, block_nodes: int) -> Shape:
        if fanout < 2:
            raise ValueError("a parent has two children at least")
        span = 1
        while fanout ** (span + 1) <= block_nodes:
            span += 1
        return cls(fanout, span)

    @property
    def nodes(self) -> int:
        return self.fanout**self.span

    def levels(self, total: int) -> int:
        """Levels over a block of a tree with so many nodes: up to its top if the tree is one block."""
        if total > self.nodes:
            return self.span
        count = 0
        while total > 1:
            total, count = -(-total // self.fanout), count + 1
        return count

    def over(self, table: pa.Table) -> Levels:
        """The levels over the nodes of one block, in their order."""
        return Levels(table["digest"].to_pylist(), self.levels(table["total"][0].as_py()), self.fanout)


def numbered(frame: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows with their `position` (from 0) in their group and its `total`, without a task that sees a group.

    Rows alike in all of `order` get different positions in the order they are read.
    """
    stamped = texts.written(frame.withColumn("arrival", F.monotonically_increasing_id()))
    keys = [group, *order, "arrival"]
    ranged = stamped.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("arrival")
    ranged = ranged.withColumn("at", F.monotonically_increasing_id())
    ranged = texts.written(ranged.withColumn("piece", F.shiftright("at", 33)))
    pieces = ranged.groupBy(group, "piece").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    pieces = pieces.select(
        group, "piece", (F.sum("n").over(whole.orderBy("piece")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("total"),
    )
    return ranged.join(pieces, [group, "piece"]).withColumn("position", F.col("at") + F.col("shift")).drop("piece", "at", "shift")


def _blocked(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("position") / shape.nodes))


def _tops(nodes: DataFrame, shape: Shape) -> DataFrame:
    """The nodes of the next round: tops of blocks."""

    def top(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        total = -(-table["total"][0].as_py() // shape.nodes)
        return pa.table({"tree": [key[0].as_py()], "position": [key[1].as_py()], "total": [total], "digest": [shape.over(table).top]})

    few = _blocked(nodes.select("tree", "position", "total", "digest"), shape)
    return few.groupBy("tree", "block").applyInArrow(top, "tree string, position long, total long, digest string")


def _above(nodes: DataFrame, shape: Shape) -> DataFrame:
    """(tree, block, path, top) of each block of the nodes: the way from its top to that of the tree."""
    tops = texts.written(_tops(nodes, shape))
    if tops.filter("total > 1").isEmpty():
        found = tops.select("tree", "position", F.array().cast(PATH).alias("path"), F.col("digest").alias("top"))
    else:
        found = _paths(tops, _above(tops, shape), shape)
    return found.withColumnRenamed("position", "block")


def _paths(nodes: DataFrame, above: DataFrame, shape: Shape) -> DataFrame:
    """(tree, position, path, top) of each node, from what lies above its block."""

    def path(table: pa.Table, upper: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        levels, rest = shape.over(table), upper["path"][0].as_py()
        return pa.table(
            {
                "tree": table["tree"],
                "position": table["position"],
                "path": pa.array([levels.path(place) + rest for place in range(table.num_rows)], pa.list_(STEP)),
                "top": pa.array([upper["top"][0].as_py()] * table.num_rows, pa.string()),
            }
        )

    left = _blocked(nodes.select("tree", "position", "total", "digest"), shape).groupBy("tree", "block")
    right = above.groupBy("tree", "block")
    return left.cogroup(right).applyInArrow(path, f"tree string, position long, path {PATH}, top string")


def manifest(
    rows: DataFrame,
    leaf: Column,
    replacement: Column | None = None,
    group: str = "lang",
    order: str = "doc_id",
    fanout: int = 2,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """Trees over rows: one per value of `group`, its leaves ascending by `order`, and one over these.

    While several nodes remain, every `fanout` consecutive ones become the hash of their hex
    digests; a last run may be shorter, down to one. The tops of groups, ordered by group (null
    first, bytewise), likewise give the root. `leaf` is the digest of a row, and `replacement`
    the one it is folded with (none: its own).

    Returns `order`, `group`, leaf, subroot, root, position (in the group, from 0), proof (the
    steps to the root: slot and siblings) and folded_root; verified says whether that is the
    root. Rows of one `order` stand in the order of their digests, equal rows in the order they
    are read; rows without `order` come first. Every row is a leaf, whatever is null or empty;
    very long texts are hashed by Spark, and only digests go on from there. An empty table gives
    no rows. Other columns are left behind, so their names cannot clash.
    """
    shape = Shape.of(fanout, block_nodes)
    named = rows.select(
        F.col(order).alias("id"),
        # Ordered as the group is, nulls first, and never null.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("tree"),
        F.col(group).alias("value"),
        leaf.alias("digest"),
        (leaf if replacement is None else replacement).alias("other"),
    )
    leaves = numbered(named, "tree", ["id", "digest"])
    above = _above(leaves, shape)

    groups = above.filter("block = 0").select(F.lit("").alias("forest"), "tree", F.col("top").alias("digest"))
    forest = numbered(groups, "forest", ["tree"]).withColumnsRenamed({"tree": "name", "forest": "tree"})
    roots = _paths(forest, _above(forest, shape), shape)
    roots = roots.join(forest.select("position", "name"), "position").select(
        F.col("name").alias("tree"), F.col("path").alias("rest"), F.col("top").alias("root")
    )
    above = above.join(roots, "tree").select(
        "tree", "block", F.concat("path", "rest").alias("path"), F.col("top").alias("subroot"), "root"
    )

    kind = leaves.schema
    schema = f"id {kind['id'].dataType.simpleString()}, value {kind['value'].dataType.simpleString()}, leaf string, subroot string, "
    schema += f"root string, position long, proof {PATH}, folded_root string"

    def folded(table: pa.Table, upper: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        levels, rest = shape.over(table), upper["path"][0].as_py()
        climb = Climb(rest)
        count = table.num_rows
        same = lambda name: pa.array([upper[name][0].as_py()] * count, pa.string())
        return pa.table(
            {
                "id": table["id"],
                "value": table["value"],
                "leaf": table["digest"],
                "subroot": same("subroot"),
                "root": same("root"),
                "position": table["position"],
                "proof": pa.array([levels.path(place) + rest for place in range(count)], pa.list_(STEP)),
                "folded_root": pa.array(
                    [climb.folded(levels.folded(place, other)) for place, other in enumerate(table["other"].to_pylist())], pa.string()
                ),
            }
        )

    blocks = _blocked(leaves, shape).groupBy("tree", "block")
    found = blocks.cogroup(above.groupBy("tree", "block")).applyInArrow(folded, schema)
    return found.withColumnsRenamed({"id": order, "value": group}).withColumn("verified", F.col("folded_root") == F.col("root"))
