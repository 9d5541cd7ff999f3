"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every neighbour above a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and the nodes below it to the least of them; ``u`` is above ``v`` in each row."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u")
    kept = out.select("u", F.col("m").alias("v"))
    moved = out.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(moved).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link; ``root`` is the least node of its component.

    ``edges`` has the bigint columns ``u`` and ``v``; direction, repetition and
    loops do not matter.  Each round is written to the shared folder; the number
    of rounds grows with the logarithm of the longest chain.
    """
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        # Done when no node has two parents and no parent has one.
        sides = edges.groupBy("u").agg(F.count("*").alias("n")).alias("a")
        parents = edges.select(F.col("v").alias("p")).distinct()
        bad = sides.join(parents, F.col("u") == F.col("p"), "left").where("n > 1 OR p IS NOT NULL")
        if bad.isEmpty():
            break
        edges = stage(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
