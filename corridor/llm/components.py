"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.storage import materialise


def _lowest(pairs: DataFrame) -> DataFrame:
    """Per node u the smallest of u and its neighbours v."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))


def _is_settled(edges: DataFrame) -> bool:
    """Whether the links are stars around their smallest nodes: nobody links twice, and nobody linked to links on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    told = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not told.agg(F.max((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0)))).first()[0]


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Each step only joins links with a minimum per node, so a node with many
    links is pre-aggregated before the shuffle. Every state is written to the
    shared folder; the loop ends when the links are stars. An empty table
    gives an empty result, repeated links and self-links change nothing.
    """
    edges = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where("u <> v").distinct(), "links")
    while not _is_settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_lowest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        large = materialise(large.where("u <> v"), "large")
        low = _lowest(large)
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct())
        edges = materialise(small, "small")
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    return roots.select(F.col("u").alias("node"), "component").unionByName(
        roots.select(F.col("component").alias("node"), "component").distinct())
