"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _stars(edges: DataFrame) -> bool:
    """Whether every node with an edge down has one only, to a node without any (true without edges)."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    down, up = F.sum("down"), F.max("up")
    return ends.groupBy("n").agg(down.alias("down"), up.alias("up")).where("down > 1 or down > 0 and up > 0").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long): the smallest node reachable.

    Each round hangs a node's larger neighbours on its smallest one, then its smaller ones;
    rounds end when only stars are left, after a number that grows with the logarithm of the longest
    chain.  Minima are aggregated before the shuffle and the joins can be split, so a star of
    any size is no single task.  Each round is written to the shared folder."""
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        # large star: neighbours above a node move to its smallest neighbour (or itself)
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stage(both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        # small star: a node and its neighbours below it move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        now = stage(moved.select("a", F.col("m").alias("b")).union(moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                    .distinct(), "edges")
    # every node points at the smallest of its component
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
