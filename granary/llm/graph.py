"""Connected components of an edge table, and of few edges inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import texts


class Forest:
    """Disjoint sets of the numbers 0 to n - 1, each named by its smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        """The root of every member at once, by pointer jumping."""
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of edges a, b (long).

    Every round points each node at its smallest neighbour, follows the pointers twice,
    and contracts the edges; at least half of the nodes that still have edges vanish, so
    that the rounds grow with the logarithm of the nodes. Nothing is collected.
    """
    edges = texts.written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    )
    steps = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("up")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("up"))
        )
        step = both.groupBy("node").agg(F.min("up").alias("up")).select("node", F.least("node", "up").alias("up"))
        for _ in range(2):
            higher = step.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            step = step.join(higher, "up").select("node", F.col("higher").alias("up"))
        step = texts.written(step)
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("up").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("up").alias("y"))
        moved = edges.join(left, "a").join(right, "b")
        edges = texts.written(
            moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct()
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0].select("node", F.col("up").alias("component"))
    for step in steps[1:]:
        next_step = step.select(F.col("node").alias("component"), "up")
        found = found.join(next_step, "component", "left").select(
            "node", F.coalesce("up", "component").alias("component")
        )
    return found
