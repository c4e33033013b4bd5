"""Average effects at all levels of several dimensions in one pass over the rows.

Rows are reduced to moments (count, mean, sum of squared deviations) of the finest cells,
and only those few rows are expanded over the grouping sets, in which moments merge.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cube_sets(dims: list[str]) -> list[list[str]]:
    """All subsets of the dimensions."""
    return [list(c) for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def rollup_sets(dims: list[str]) -> list[list[str]]:
    """The dimensions, and what is left of them from the last on."""
    return [dims[:n] for n in range(len(dims), -1, -1)]


def effect_cells(df: DataFrame, treatments: list[str], dims: list[str]) -> DataFrame:
    """(dims, treatment, estimand, n, mean, m2): moments of {t}_dre over all rows (ATE) and over treated ones (ATT), nulls aside."""
    kinds = [(t, "ATE", F.col(f"{t}_dre")) for t in treatments] + [(t, "ATT", F.when(F.col(f"is_treated_by_{t}") == 1, F.col(f"{t}_dre"))) for t in treatments]
    # one row a value: each is computed once, where moments side by side would repeat its whole expression in each of them
    values = F.array(*[F.struct(F.lit(t).alias("treatment"), F.lit(e).alias("estimand"), c.cast("double").alias("v")) for t, e, c in kinds])
    long = df.select(*dims, F.inline(values)).filter("v is not null")
    return long.groupBy(*dims, "treatment", "estimand").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("*")).alias("m2"))


def effects_by(df: DataFrame, treatments: list[str], dims: list[str], sets: list[list[str]] | None = None) -> DataFrame:
    """effects_of_cells of the rows' own cells."""
    return effects_of_cells(effect_cells(df, treatments, dims), dims, sets)


def effects_of_cells(cells: DataFrame, dims: list[str], sets: list[list[str]] | None = None) -> DataFrame:
    """(dims, level, treatment, estimand, n, estimate, ci_lo, ci_hi), a row for every cell of every
    set of dimensions (all subsets, unless given), with mean +- 1.96 sd / sqrt(n). Cells may be finer than
    the dimensions, which may have been joined to them. A dimension that is summed over is null;
    level tells that from a null in the data: its bit, the last dimension's being 1, is set."""
    fixed = ["treatment", "estimand"]
    grouped = cells.groupingSets([[*s, *fixed] for s in (cube_sets(dims) if sets is None else sets)], *dims, *fixed)
    n, total = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    mean = total / n
    m2 = F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
    out = grouped.agg(F.shiftright(F.grouping_id(), len(fixed)).alias("level"), n.alias("n"), mean.alias("estimate"), F.greatest(m2, F.lit(0.0)).alias("m2"))
    half = F.when(F.col("n") > 1, 1.96 * F.sqrt(F.col("m2") / (F.col("n") - 1) / F.col("n")))
    return out.select(*dims, "level", *fixed, "n", "estimate", (F.col("estimate") - half).alias("ci_lo"), (F.col("estimate") + half).alias("ci_hi"))
