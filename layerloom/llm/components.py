"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its lower neighbours are tied to the least of them; needs u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, root`` for every node of ``edges(u, v)`` that is not its component's least node.

    Each round is written, so a lost executor costs one round. Aggregations are minima and
    combine before the shuffle; a hub is only large in joins, whose partitions Spark splits.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        facts = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if tuple(facts) == seen:
            return edges.select("u", F.col("v").alias("root"))
        seen = tuple(facts)
        edges = written(_small_star(_large_star(edges)), "edges")
