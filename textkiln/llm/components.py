"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two joins of edges with per-node minima and is written to the shared folder, so a
lost executor repeats one round at most. Nothing is collected but one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.llm.tables import dropped, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``a, b`` with ``a`` != ``b`` -> ``node, component`` (the least node reached) for every node with an edge."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), f"{label}-0")
    count, seen = now.count(), None
    k = 0
    while count:
        k += 1
        nxt = written(_small_star(_large_star(now)), f"{label}-{k}")
        # stars have one edge a node; a fixed point is a set of stars
        here = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        state = (here[0], here[1])
        dropped(now)
        now = nxt
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
