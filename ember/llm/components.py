"""Connected components of a link table, with hot nodes and long chains in mind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm.staging import staged


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for the ends of ``links(u, v)``.

    Alternating large-star and small-star steps: after O(log^2) rounds every
    node hangs directly under the smallest node of its component, which one
    aggregation over the ends of the edges tells.  Each round is two
    aggregations and two joins on edges alone and is staged, so lineage stays
    short; a node with very many links is pre-aggregated before the shuffle
    and its join partition may be split at run time.
    """
    edges = staged(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # Large star: every larger neighbour moves under the smallest one.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: the smaller neighbours and the node itself do the same.
        moved = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    up = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return up.unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Does every node have one parent at most, and no parent a parent of its own?"""
    child = edges.select(F.col("u").alias("node"), F.col("v").alias("parent"))
    parent = edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("parent"))
    node = child.unionByName(parent).groupBy("node").agg(
        F.min("parent").alias("low"), F.max("parent").alias("high"), F.max(F.col("parent").isNull()).alias("has_children"))
    return node.filter("low < high OR (low IS NOT NULL AND has_children)").isEmpty()
