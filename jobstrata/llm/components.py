"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.storage import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the smallest one around the node."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    joined = down.join(least, "a")
    return (
        joined.where("b > low")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .union(least.select("a", F.col("low").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node with a link the smallest node it reaches.

    ``edges`` has long columns a and b; loops and repeats are allowed. Each round is
    written to the checkpoint folder; the number of rounds is logarithmic in the longest
    chain, and a node's many neighbours meet only in map-side combined minima.
    """
    edges = checkpointed(edges.where("a <> b").distinct())
    state = None
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen
