"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.store import cut


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``): the component is its smallest node.

    Each round hangs every node's neighbours below the smallest of them, first the larger ones, then all (large star, small star),
    until nothing moves. Rounds grow with the logarithm of the longest path; minima are partial aggregates, so a node with very many
    neighbours is no hot group, and Spark can split its rows in the join. Loops and nulls are ignored. Only a count and a checksum of
    the edges reach the driver.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Larger neighbours hang below the smallest neighbour.
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Every node points down now; its smallest target takes the node and its other targets.
        lowest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(lowest, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))
