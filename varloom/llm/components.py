"""Connected components of an edge table, with narrow joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint); the root is a node of the component.

    Each round every node points to its least neighbour, pointers are followed twice, and the edges
    are drawn again between what they point to; rounds end when no edge is left. A hub is one row of an
    aggregate that combines before the shuffle. Rounds grow with the logarithm of the longest chain.
    """
    e = edges.filter("a <> b").select("a", "b")
    e = settled(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    names = settled(e.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")))
    while not e.isEmpty():
        up = e.groupBy("a").agg(F.min(F.least("a", "b")).alias("p"))
        for _ in range(2):
            up = settled(up)
            over = up.select(F.col("a").alias("p"), F.col("p").alias("q"))
            up = up.join(over, "p").select("a", F.col("q").alias("p"))
        up = settled(up)
        names = settled(names.join(up.select(F.col("a").alias("root"), "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root")))
        e = e.join(up, "a").select(F.col("p").alias("x"), "b").join(up.select(F.col("a").alias("b"), F.col("p").alias("y")), "b")
        e = settled(e.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    return names
