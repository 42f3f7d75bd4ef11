"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sinks.files import Stage

MAX_ROUNDS = 60


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``a`` and its smallest neighbour ``m``. Grouped by a struct, so that the result is
    shuffled once more for the join and AQE may split the partition of a node with very many
    edges: it does so only if both sides come straight from a shuffle."""
    return edges.groupBy(F.struct("a").alias("_k")).agg(F.min("b").alias("m")).select("_k.a", "m")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for all nodes of ``edges``.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type. Each round connects the
    larger neighbours of every node to its smallest one (large star) and then its smaller
    neighbours (small star); both keep the components, and the number of rounds grows with
    the logarithm of the longest chain. Minima fold before their shuffle and neighbours are
    never gathered, so a node with very many edges is no burden. Each round is written to
    the shared folder, so a lost executor costs a re-read.
    """
    current = stage.save(edges.where("a <> b").select("a", "b").distinct(), "edges-0")
    for turn in range(1, MAX_ROUNDS + 1):
        ways = _both_ways(current)
        least = _least_neighbour(ways).withColumn("m", F.least("m", "a"))
        large = ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: edges now point from larger to smaller.
        least = _least_neighbour(large)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        current = stage.save(small, f"edges-{turn}")
        if not _unfinished(current):
            nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return nodes.union(nodes.select("root", "root").distinct())
    raise ValueError(f"components are not stable after {MAX_ROUNDS} rounds")


def _unfinished(edges: DataFrame) -> int:
    """Nodes that have two smaller neighbours, or one and a larger one: none in lone stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.where("up > 1 OR (up = 1 AND down = 1)").count()
