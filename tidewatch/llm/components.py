"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step (Kiveris et al. 2014): neighbours of each node are linked to the least node among it and them.

    The large star moves neighbours above the node, the small one those below it and the node itself. The least node is a partial
    aggregate; it meets the edges in a join, whose hot nodes adaptive execution splits.
    """
    if larger:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    met = edges.join(least, F.col("a") == F.col("node"))
    if larger:
        moved = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node of ``edges`` (``a``, ``b``: longs): the least node of its component.

    Rounds end when no edge changes, after about log(diameter) of them; each is stored.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    known = None
    while True:
        mark = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == known or not mark[0]:
            break
        known = mark
        edges = stored(_star(_star(edges, True), False), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
