"""Connected components of an edge table, by alternating star joins.

Map tasks first put stars in the place of what their own edges connect, so that few rounds are left to join; a round is a plan of
many exchanges, and what the driver holds grows with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualpath.llm.common import discard, written

EDGES = 1 << 20  # edges united at a time


class Forest:
    """Union of positions 0..n-1, many links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low < high
            if not apart.any():
                return
            a, b = low[apart], high[apart]
            np.minimum.at(self.root, b, a)
            while True:  # point at the roots
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges u, v to stars: of EDGES or so at a time, each node and the least that these edges reach from it."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v"))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        forest = Forest(len(nodes))
        forest.join(at[: len(u)], at[len(u) :])
        linked = np.flatnonzero(forest.root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[forest.root[linked]])], names=["u", "v"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= EDGES:
            yield stars(held)
            held, size = [], 0
    if size:
        yield stars(held)


def _neighbours_to_least(edges: DataFrame, up: bool) -> DataFrame:
    """Links each node's neighbours (above it, or it and those below it) to the least of them and itself."""
    if up:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # Least neighbours are pre-aggregated in map tasks; the join back has one row per node there, so Spark may split
    # the neighbours of a hub.
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(least, "u")
    if up:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter("u <> v")


def _all_stars(edges: DataFrame) -> bool:
    """Each u has one edge, and no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 0) & (F.col("up") + F.col("down") > 1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node that can be reached, for every node of an edge (u, v) of two different longs.

    The edges are a table; each round is written to the shared folder. Ends when all edges lead to the least node of their
    component, after a number of rounds that grows with the logarithm of the longest path.
    """
    edges = written(edges.select("u", "v").mapInArrow(united, "u long, v long"), "stars")
    while not _all_stars(edges):
        # Written between: the second step reads the first three times, and in one plan it would stand there as often.
        above = written(_neighbours_to_least(edges, True), "above")
        discard(edges)
        edges = written(_neighbours_to_least(above, False).distinct(), "stars")
        discard(above)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
