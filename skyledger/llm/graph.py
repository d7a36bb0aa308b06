"""Connected components of a link table by alternating stars, on Spark only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (columns a, b); a component is its smallest node.

    Each round hangs every larger neighbour of a node on the node's smallest neighbour, then does
    the same with the smaller ones, until nothing moves. Rounds grow with the logarithm of the
    longest path; a node with very many links is reduced by partial aggregation, never gathered.
    """
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while (state := edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = state
        if not state[0]:
            break
        edges = staged(_small_star(_large_star(edges)), "edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
