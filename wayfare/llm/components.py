"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum of them."""
    # Edges are distinct; a sum of hashes would overflow with millions of them.
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links ``a``, ``b``: the smallest node it can reach.

    Alternates large and small stars: each node's larger neighbours are tied to its smallest one,
    then its smaller ones are, until nothing changes, which takes a number of rounds that grows
    with the logarithm of the number of nodes. The minima are written before they are joined, so
    that the joins are plain ones whose hot nodes the adaptive planner can split.
    No links give no rows.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large-minima")
        large = staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small-minima")
        tied = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
