"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.frames import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of every node to the least id around it.

    Large star moves the larger neighbours, small star the smaller ones and the node.
    Both keep the components; minima are aggregates, so a node may have any number of
    neighbours.
    """
    around = _both_ways(edges).filter("a != b")
    if not large:
        around = around.filter("b < a")
    least = stored(around.groupBy("a").agg(F.min("b").alias("m"))
                   .select("a", F.least("a", "m").alias("m")), "star")
    moved = around.filter("b > a") if large else around
    out = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the (a, b) edges, named by its least node.

    Rounds go on until the edges no longer change, about log2 of the longest chain.
    Loops and repeated edges do no harm; a node without another neighbour is left out.
    """
    edges = stored(edges.filter("a != b").distinct(), "edges")
    mark = None
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    joined = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return joined.unionByName(
        joined.select(F.col("component").alias("node"), "component").distinct()).distinct()
