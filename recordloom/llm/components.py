"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import materialize


def _print_of(edges: DataFrame) -> tuple:
    """Count and hash sums of an edge set: the same for the same set."""
    h = F.xxhash64("u", "v")
    low, high = h.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(h, 33)
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(low), F.sum(high)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of `links` (a, b: long, a <> b); root is the smallest node reachable.

    Each round is written to the shared folder, so a lost executor costs one round at most.
    The number of rounds grows with the logarithm of the longest chain. No links, no rows.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = materialize(links.filter("a <> b").select(u, v).distinct(), "links")
    last = _print_of(edges)
    while last[0]:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        now = _print_of(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
