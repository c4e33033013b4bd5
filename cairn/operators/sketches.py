"""Mergeable sketches as a stored data structure: who was reached (theta), how values are spread (KLL).

A sketch of each finest cell is a row of a table, partitioned as the caller likes; any
coarser question is a merge of a few rows, and new days only add rows. A theta sketch of
2^lg entries is exact up to that many distinct keys and beyond has a relative standard
error of about 1 / sqrt(2^lg); an intersection's error is that share of the union. A KLL
sketch of size k errs by about 1.7 / k^0.9 in rank (99 %). Null keys and values count for nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 12  # theta sketches have 2^LG entries
KLL = 200


def relative_error(lg: int = LG, sigmas: float = 3.0) -> float:
    return sigmas / math.sqrt(2**lg)


def rank_error(k: int = KLL) -> float:
    return 2.296 / k**0.9021


def reach(events: DataFrame, by: list[str], who: str, lg: int = LG) -> DataFrame:
    """(by, reach: sketch of the distinct keys)."""
    return events.groupBy(*by).agg(F.theta_sketch_agg(who, lg).alias("reach"))


def spread(events: DataFrame, by: list[str], value: str, k: int = KLL) -> DataFrame:
    """(by, spread: sketch of the values)."""
    return events.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("spread"))


def merged(sketches: DataFrame, by: list[str], lg: int = LG, k: int = KLL) -> DataFrame:
    """Sketches of coarser cells, from those of finer ones; columns reach and spread, as far as they are there."""
    aggs = [F.theta_union_agg("reach", lg).alias("reach")] * ("reach" in sketches.columns) + [F.kll_merge_agg_double("spread", F.lit(k)).alias("spread")] * ("spread" in sketches.columns)
    return sketches.groupBy(*by).agg(*aggs)


def size(sketch: Column) -> Column:
    """Distinct keys, about."""
    return F.theta_sketch_estimate(sketch)


def both(a: Column, b: Column) -> Column:
    """The sketch of the keys that are in both."""
    return F.theta_intersection(a, b)


def quantile(sketch: Column, p: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))


def overlaps(sketches: DataFrame, cell: str, by: list[str] = ()) -> DataFrame:
    """(by, a, b, n_a, n_b, n_both, n_either) for pairs a < b of cells (few by nature: arms, channels), from sketches (by, cell, reach)."""
    side = lambda name: sketches.select(*by, F.col(cell).alias(name), F.col("reach").alias(f"r_{name}"), F.lit(1).alias("_one"))
    pairs = side("a").join(side("b"), [*by, "_one"]).filter("a < b")
    return pairs.select(*by, "a", "b", size(F.col("r_a")).alias("n_a"), size(F.col("r_b")).alias("n_b"), size(both(F.col("r_a"), F.col("r_b"))).alias("n_both"), size(F.theta_union("r_a", "r_b")).alias("n_either"))
