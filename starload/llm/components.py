"""Connected components by alternating large-star and small-star rounds.

Edges are (a, b) pairs of 64-bit node numbers. Each round is a few joins and aggregations
over the edges that are left, whose number never grows, and ends in a table in the shared
folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.filter("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from larger to smaller; a node and its neighbours get the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node), for nodes that have an edge to another node.

    Order and repetition of edges are free; loops are ignored.
    """
    ordered = edges.select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    current = stored(ordered.filter("a != b").distinct(), "edges")
    while True:
        # Stars: nobody has two centres and no centre has one itself.
        least = current.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        centres = current.select(F.col("b").alias("a")).distinct()
        if least.filter("n > 1").isEmpty() and centres.join(current, "a", "left_semi").isEmpty():
            break
        current = stored(_small_star(_large_star(current)), "edges")
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
