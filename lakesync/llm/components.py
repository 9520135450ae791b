"""Connected components of a graph that is a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.shared import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for every node with an edge: ``root`` is the smallest node it can reach, roots included.

    ``edges`` has two columns of one orderable type; repeated edges, loops and an empty table are fine. Each round
    hangs the neighbours of a node on their least one, which halves distances; rounds grow with the logarithm of the
    longest path. The edge table of each round is written to the shared folder, and the one before is dropped. A node
    with very many edges is reduced per task before its minimum is shuffled, and Spark splits it in the join back.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = scratch.cut(edges)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
        larger = scratch.cut(_large_star(edges))
        smaller = scratch.cut(_small_star(larger))
        scratch.drop(edges)
        scratch.drop(larger)
        edges = smaller
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the least of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them; ``u`` is always the larger end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
