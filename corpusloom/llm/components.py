"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import tables


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; ``root`` is the smallest node that can be reached.

    Each round is two shuffles of the links, written before the next one; the links stay about as many, and the number
    of rounds grows with the logarithm of the longest chain. A hub's neighbours are never gathered: its smallest one
    is a pre-aggregated minimum, and joins on it can be split.
    """
    edges = tables.written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # Large star: every larger neighbour of a node is linked to the smallest of the node and its neighbours.
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        linked = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = tables.written(linked.distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
