"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.storage import drop_snapshot, snapshot, work_dir


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_smallest(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "a").select("a", "b", "least")


def _round(edges: DataFrame) -> DataFrame:
    """Larger neighbours, then all smaller ones, are tied to the smallest neighbour of a node."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    large = _to_smallest(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("least").alias("b"))
    large = large.filter("a <> b")
    least = large.groupBy("a").agg(F.min("b").alias("least"))
    tied = _to_smallest(large, least)
    small = tied.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    )
    return small.filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Does every edge lead to a node that is the only one for its own, and leads nowhere itself?"""
    seen = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("aim")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("aim"))
    )
    found = seen.groupBy("node").agg(F.sum("out").alias("out"), F.max("aim").alias("aim"))
    return found.filter("out > 1 or (out = 1 and aim = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of the edges (a, b).

    Star contraction: the number of rounds grows with the logarithm of the
    longest path. Every round is written to the shared folder, so plans stay
    short and a lost executor costs one round at most. Loops and repeated
    edges do no harm; nulls are no nodes.
    """
    spark = edges.sparkSession
    folder = work_dir(spark)
    # A node's larger neighbours all point to it: both parts below keep a > b.
    tidy = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, number = snapshot(tidy, f"{folder}/0"), 0
    while not _settled(current):
        number += 1
        following = snapshot(_round(current), f"{folder}/{number}")
        drop_snapshot(spark, f"{folder}/{number - 1}")
        current = following
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
