"""Connected components of a distributed edge list, in DataFrame functions only."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _larger(edges: DataFrame) -> DataFrame:
    """Large star: a node's larger neighbours hang on its least neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours hang on the least of these. Edges lead from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root for every node of the edges (a, b): root is the least node that can be reached.

    Alternating large and small stars; the number of rounds grows with the logarithm of the longest path. Each round is
    cut through the shared folder. Nodes may be of any type that has an order. Loops and repeated edges do no harm; nodes of loops only, and null ends, are left
    out; no edges give no rows."""
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.col("a").isNull().alias("n"), F.col("b").isNull().alias("m")).where("not n and not m and a <> b").select("a", "b").distinct())
    before = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        now = cut(_smaller(_larger(now)))
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
