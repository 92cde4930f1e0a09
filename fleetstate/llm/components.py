"""Connected components: of a distributed graph by alternating star contractions, and of places inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction: hang the larger (or the smaller) neighbours of each node on its least neighbour."""
    if larger:
        around = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    hung = around.join(least, "a")
    if larger:
        hung = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        hung = hung.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return hung.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of `edges` (a, b) can reach.

    Nodes are of any type with an order. Each round is a minimum per node (summed up before the shuffle) and a join,
    which Spark splits where one node has a great part of the edges. The rounds end when a full pass changes nothing;
    their number grows with the logarithm of the graph's size. Loops are allowed; nodes without other edges than a
    loop are not returned. No edges give no rows.
    """
    edges = settle(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct())
    mark = None
    while True:
        edges = settle(_stars(_stars(edges, larger=True), larger=False))
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a")).alias("y")
        ).first()
        if seen == mark or seen["n"] == 0:
            break
        mark = seen
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


class Forest:
    """Least reachable place of each place, with the runs of equal names that allow whole nodes to be skipped."""

    def __init__(self, n: int):
        self.name = np.arange(n)
        self._mark()

    def _mark(self) -> None:
        change = np.flatnonzero(np.diff(self.name)) + 1
        stops = np.append(change, len(self.name))
        self.run_end = stops[np.searchsorted(stops, np.arange(len(self.name)), side="right")]

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the components of each pair of places."""
        a, b = self.name[a], self.name[b]
        while len(a):
            low, high = np.minimum(a, b), np.maximum(a, b)
            new = low < high
            low, high = low[new], high[new]
            if not len(low):
                break
            parent = np.arange(len(self.name))
            np.minimum.at(parent, high, low)
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            self.name = parent[self.name]
            a, b = parent[low], parent[high]
        self._mark()

    def joined(self, lo1, hi1, lo2, hi2) -> np.ndarray:
        """Whether two whole ranges are one component already."""
        return (self.name[lo1] == self.name[lo2]) & (self.run_end[lo1] >= hi1) & (self.run_end[lo2] >= hi2)
