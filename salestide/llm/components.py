"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.session import discard, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every greater neighbour of a node to the least node of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its lesser neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of all nodes with an edge to another; edges are columns ``a`` and ``b``.

    Stars are rewired until nothing changes, in about as many rounds as the logarithm of the longest chain.
    Each round is stored, so that a lost executor repeats at most one; a node with very many edges is summed
    before it is shuffled.
    """
    now = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    for turn in range(MAX_ROUNDS):
        before, now = now, materialize(_small_star(_large_star(now)).distinct(), f"edges-{turn}")
        discard(before)
        state = now.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))
        ).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
