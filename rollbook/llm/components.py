"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.staging import stage


def connected(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the links (a, b); root is the smallest node reachable.

    Alternating large and small stars: each round ties every node to the
    smallest of its neighbourhood, until only stars are left.  The smallest
    neighbours are written before they are joined, so the join has exchanges
    on both sides and a node with very many links is split.  Ids must not be
    NULL; no links give no rows.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    while not _stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stage(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = stage(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour or only larger ones."""
    ends = edges.select(F.col("u").alias("x"), "v").unionAll(edges.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("v")))
    seen = ends.groupBy("x").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.when(F.col("v").isNull(), 1)).alias("above"))
    return seen.filter("low != high or (low is not null and above > 0)").isEmpty()
