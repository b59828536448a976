"""Connected components of a table of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import stored


def _lowest(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Lowest neighbour of every node. Written down first, so that the join after it can split a hub's rows."""
    return stored(edges.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low")), "lowest")


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``links`` (u, v) but the roots themselves.

    Links of a node to itself are ignored. Each step combines before it shuffles and emits at most two rows a link.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, last = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (state["n"], state["h"]) == last or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = (state["n"], state["h"])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both, "u", "v")
        large = both.join(low, F.col("u") == F.col("node")).where("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct()
        large = stored(large, "large-star")
        low = _lowest(large, "u", "v")
        small = large.join(low, F.col("u") == F.col("node")).select("u", "v", "low")
        edges = stored(small.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").unionByName(low.select(F.col("node").alias("u"), F.col("low").alias("v"))).distinct(), "small-star")
