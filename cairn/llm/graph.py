"""Connected components by alternating large and small stars, as DataFrame joins.

Edge cases: edges with a null end count for nothing, loops and repeated edges for no more
than one; without edges the result is empty. Rounds grow with the logarithm of the longest
path; beyond MAX_ROUNDS it raises. Other columns of edges are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .env import staged

MAX_ROUNDS = 40


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs (u, v): every u's neighbours v are tied to the least of them and u."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = pairs.alias("p").join(least.alias("l"), F.col("p.u") == F.col("l.u")).select(F.col("p.u").alias("u"), F.col("p.v").alias("v"), F.col("l.m").alias("m"))
    out = tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v: long) to (u, label): label is the least node that u reaches; nodes
    without an edge to another and the labels themselves do not appear."""
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.withColumnRenamed("v", "label")
        mark = tuple(seen)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = staged(_star(both, True), "edges")
        now = staged(_star(now, False), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
