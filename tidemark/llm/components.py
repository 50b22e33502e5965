"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is two exchanges of the edge list; no component is ever gathered in one task.
A hub's edges meet its minimum in a join that adaptive execution can split. Each round
is written to the shared folder, so a lost executor doesn't restart the iteration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
        "a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    near = edges.join(least, F.col("a") == F.col("k"))
    moved = near.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("k").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node that each node of an edge list (a, b) reaches.

    Nodes are longs. Loops and repeated edges don't matter; nodes without an edge
    aren't listed. An empty edge list gives no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = staged(e, "edges")
    before = None
    for _ in range(max_rounds):
        # after both steps every edge points from a node to a smaller one
        e = staged(_small_star(_large_star(e)), "edges")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0)).alias("h")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
