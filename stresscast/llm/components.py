"""Connected components of a distributed edge list by alternating large-star / small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every round is two
aggregations and two equi-joins; nothing is gathered on the driver but one row of counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest of them (edges run from a down to b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("root").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges(a, b)`` of longs to ``(node, root)`` with the smallest reachable node; isolated nodes do not appear.

    Self-loops, repeated and reversed edges and null ends are ignored. Raises if ``max_rounds`` do not
    suffice (the number of rounds grows with the logarithm of the longest chain).
    """
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = staged(cur, "edges")
    mark = None
    for _ in range(max_rounds):
        cur = staged(_small_star(_large_star(cur)), "stars")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                cur.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
