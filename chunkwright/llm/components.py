"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm import shared


def _stars(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_stars(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _stars(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v), with root the smallest node that it reaches; roots aren't listed.

    Nodes are of any type that has an order. Each round is written to the shared folder; rounds grow with the
    logarithm of the longest chain. A hub's links are aggregated before their shuffle and joined back by a join that
    Spark can split.
    """
    edges = shared.written(links.where("u != v").select("u", "v").distinct(), "links")
    mark = None
    while True:
        edges = shared.written(_small(_large(edges)), "stars")
        # Once every node points at its root, another round changes nothing.
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)
