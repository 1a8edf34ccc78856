"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialise


class Forest:
    """Union-find over the ids that have been met; the root of a tree is its smallest id."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while (up := self.parent[x]) != root:
            self.parent[x], x = root, up
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.parent[b] = a
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a batch as stars around the smallest ids, with the same components: never more edges
    than before, and one batch in memory at a time."""
    for batch in batches:
        forest = Forest()
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            forest.join(a, b)
        pairs = [(x, forest.find(x)) for x in forest.parent]
        pairs = np.array([p for p in pairs if p[0] != p[1]], np.int64).reshape(-1, 2)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (itself included)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one: then each parent is the smallest of its component."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    parents = edges.select(F.col("b").alias("a")).distinct()
    return several.unionByName(edges.select("a").join(parents, "a", "left_semi")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (columns a and b, long, not null) that is not the smallest of
    its component; component is the smallest id. No edges give no rows.

    Each round contracts the edges batch by batch, then runs both stars. A round is written to the shared
    folder, so a lost executor costs at most one round. Ends when only stars are left."""
    spark = edges.sparkSession
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    while True:
        edges = edges.transform(arrow_map, _contract, "a long, b long")
        edges = materialise(spark, _small_star(_large_star(edges)).distinct(), "components")
        if _all_stars(edges):
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
