"""Distributed union-find: alternating large-star and small-star rounds.

Edges are pairs of comparable node ids. Each round is two aggregates and joins
that Spark partitions by node; no neighbourhood is gathered into one row, so a
node with a huge degree costs a skewed join (split by adaptive execution), not
a large group. Rounds end when neither the number of edges nor their checksum
changes; what remains is a star around the smallest node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"),
                                                        F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (linked.unionAll(low.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node``, ``root`` for every node that has an edge.

    ``edges`` holds columns ``u`` and ``v``; ``root`` is the smallest node of
    the component. Repeated edges, loops (dropped) and null ends (dropped) are
    allowed; no edges give an empty result.
    """
    edges = cut(edges.select("u", "v").filter("u <> v").distinct())
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)))
        if (now := _state(edges)) == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
