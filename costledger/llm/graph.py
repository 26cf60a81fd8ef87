"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.llm.common import stored


class Forest:
    """Union-find over 0 .. n - 1 inside a task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def spanning(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """Joins all pairs; returns those that joined two trees."""
        kept = []
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                kept.append((a, b))
        return kept


def contracted(left: list[int], right: list[int]) -> tuple[list[int], list[int]]:
    """The edges of one task as stars: each node that is not the smallest of its tree, and the smallest one."""
    nodes, at = np.unique(np.array([left, right], dtype=np.int64), return_inverse=True)
    forest = Forest(len(nodes))
    forest.spanning(*at.reshape(2, -1))
    roots = np.array([forest.root(x) for x in range(len(nodes))], dtype=np.int64)
    inner = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[inner].tolist(), nodes[roots[inner]].tolist()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none of those with one has a larger one."""
    sides = edges.select(F.col("u").alias("node"), F.col("v").alias("up")).union(edges.select(F.col("v"), F.lit(None).cast("long")))
    seen = sides.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max(F.col("up").isNull()).alias("above"))
    return not seen.where("low <> high OR (low IS NOT NULL AND above)").limit(1).count()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all nodes that have an edge ``a``, ``b``.

    Alternating stars: each round links a node's larger neighbours to its smallest one, then its smaller ones, until only stars are left. Minima
    are formed in the tasks and joined back, so a hub's edges are split over tasks. The number of rounds grows with the logarithm of the nodes.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    while not _stars(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("x")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        joined = large.join(least, F.col("u") == F.col("x"))
        small = least.select(F.col("x").alias("u"), F.col("m").alias("v")).union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        current = stored(small.distinct(), name)
    own = current.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), "v"))).alias("e"))
    return own.select(F.col("e.u").alias("node"), F.col("e.v").alias("component")).distinct()
