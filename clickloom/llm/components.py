"""Connected components of links that are spread over the cluster.

Alternating large-star and small-star steps: each is a minimum for each node (summed up before
the shuffle) and an equality join, whose hot side adaptive execution splits. Edges shrink towards
stars around the smallest id of each component; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, settled


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours the smallest id around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in `edges` (a, b): the smallest id that is reachable.

    Links may repeat, stand in either direction or join a node with itself (which then is alone).
    No links: an empty result. Raises if it hasn't settled after `most_rounds` rounds.
    """
    a, b = edges.columns[:2]
    now = settled(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    seen = None
    for _ in range(most_rounds):
        after = settled(_small_star(_large_star(now)))
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        dropped(now)
        now = after
        if state == seen or not state[0]:
            return now.select(F.col("b").alias("id"), F.col("a").alias("component")).union(now.select(F.col("a"), F.col("a")).distinct())
        seen = state
    raise RuntimeError(f"components: not settled after {most_rounds} rounds")
