"""Connected components by alternating large and small stars, on Spark.

Edges live in DataFrames; every round is a grouping and a join, and its result
is cut from its lineage in the shared folder.  Nothing is collected but a count
and a checksum per round.  A node with very many neighbours costs partial minima
and a join that Spark can split, never a list in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b): one row per node that isn't the smallest of its component,
    as (node, root), root being the smallest."""
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    told = None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == told:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        told = state
        now = checkpointed(_small_star(_large_star(now)))
