"""Connected components of a link table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table


def large_star(edges: DataFrame) -> DataFrame:
    """Joins every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the least of them. edges: a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
    return moved.where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node in links (a, b). Nodes without links aren't listed.

    Each step is aggregations and joins by key, so the engine can split a hub; tables are written between rounds."""
    edges = as_table(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    state = None
    while True:
        edges = as_table(small_star(large_star(edges)), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots.select("node", F.col("node").alias("component")))
