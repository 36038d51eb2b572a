"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelab.session import stage


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links`` (a, b; both bigint).

    Each round points nodes to the smallest neighbour, first from above, then from below; the number of
    rounds grows with the logarithm of the longest chain. A node with very many links is never gathered:
    its smallest neighbour is a pre-aggregated minimum, and the join back is one that Spark can split.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = stage(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    low = edges.groupBy("u").agg(F.min("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return low.select(F.col("u").alias("node"), "root").unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Two numbers that change when the edges do."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
