"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links: a, b of one orderable type. Returns node, root: the least node of each component with links.

    Rounds of large and small stars (Kiverson et al., "Connected Components in MapReduce and Beyond",
    2014): every node points its neighbours to the least of them, until all components are stars. Each
    round is one aggregation and one join per star and shrinks the depth geometrically; minima are
    combined map-side and hot nodes join through adaptive skew splitting. Rounds are cut by written
    tables; the table before the last is deleted. Links of a node with itself are ignored.
    """
    edges = scratch.store(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        large = scratch.store(_star(edges, both=True))
        small = scratch.store(_star(large, both=False))
        scratch.drop(large)
        # A star forest is stable: the same links before and after both steps.
        same = small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty()
        scratch.drop(edges)
        edges = small
        if same:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Point each (larger, if both) neighbour of a node to the least node around it."""
    around = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if both:
        around = around.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = around.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    joined = around.join(least, "node")
    if both:
        moved = joined.filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return moved.filter("a <> b").distinct()
