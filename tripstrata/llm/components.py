"""Connected components of a table of links, by alternating large and small stars.

Every round is two joins on the nodes; the minimum of a node's neighbours is reduced in the map
task and written as a table of its own, so that both sides of the join come straight from an
exchange and a node with very many links is split over tasks. Links are never gathered anywhere.

Defined results: links of a node with itself and links with a NULL end are ignored, repeated links
count once, both directions are the same; without links the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.sources.staging import drop_stage, stage_table


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node with a link can reach."""
    edges = stage_table(links.filter(f"`{a}` <> `{b}`").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = stage_table(both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")), "nearest")
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        large = stage_table(both.join(near, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
        # Small star: what lies below a node, and itself, go to the smallest below it.
        low = stage_table(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stage_table(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        # It has settled when every node has one link at most and no end of a link has one itself.
        ends = small.select(F.explode(F.array(
            F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")),
            F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))).alias("e")).select("e.*")
        left = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root")).filter(
            "up + root > 1").limit(1).count()
        for done in (edges, near, large, low):
            drop_stage(done)
        edges = small
        if not left:
            roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
