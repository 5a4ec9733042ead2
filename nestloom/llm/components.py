"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nestloom.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect neighbours of a node with the least of them: the larger ones, or the smaller ones and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else both.where("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    moved = around.join(least, "a").where("b > a" if large else "b < a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    if not large:
        moved = moved.union(least.select("a", F.col("_m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)`` that is not its component's smallest node.

    Loops, repeated links and both directions may occur. Each round is written, so no plan grows; the
    number of rounds is logarithmic in the longest path. Nothing but two sums comes to the driver.
    """
    edges, before = materialize(links.where("a <> b").select("a", "b").distinct(), "links"), None
    while True:
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(after) == before or not after[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = tuple(after)
        edges = materialize(_star(materialize(_star(edges, True), "links"), False), "links")
