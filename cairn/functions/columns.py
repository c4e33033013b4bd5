"""Scalar and conditional expressions, all native."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_ms_to_date(ms: Column) -> Column:
    """The day of an instant in epoch milliseconds, in the session's time zone."""
    return F.to_date(F.timestamp_millis(ms.cast("long")))


def look_back_sum(prefix: str, days: int) -> Column:
    """Sum of {prefix}D0 to D{days-1}; null if any day is null."""
    return reduce(add, [F.col(f"{prefix}D{i}") for i in range(days)])


def above(c: Column, threshold: float) -> Column:
    """1 if c exceeds the threshold, else (also for null) 0."""
    return F.when(c > threshold, 1).otherwise(0)


def floor_at(c: Column, cap: float = 0) -> Column:
    """Values below the cap become the cap; nulls stay."""
    return F.when(c < cap, F.lit(cap)).otherwise(c)


def purchase_weight(df: DataFrame) -> Column:
    if "adCustomerOrderItemIdCount" not in df.columns:
        return F.lit(1.0)
    n = F.col("adCustomerOrderItemIdCount").try_cast("double")
    return F.when(n > 0, 1 / n).otherwise(1.0)


def set_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()}) if values else df


def set_zeros(df: DataFrame, cols: list[str]) -> DataFrame:
    """The same columns in the same order, those named being 0."""
    return df.select(*[F.lit(0).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def has_column(df: DataFrame, c: str) -> bool:
    return c in df.columns


def within(cols: list[str], lower: float, upper: float) -> Column:
    """All columns inside [lower, upper]."""
    return reduce(and_, [F.col(c).between(lower, upper) for c in cols], F.lit(True))


def within_sql(cols: list[str], lower: float = 0.01, upper: float = 0.99) -> str:
    return " AND ".join(f"({c} BETWEEN {lower} AND {upper})" for c in cols)


def to_dense(v: Column) -> Column:
    return vector_to_array(v)


def probability_of_one(v: Column) -> Column:
    return F.get(vector_to_array(v), F.lit(1))


def dot(x: Column, coefficients: list[float]) -> Column:
    """Inner product of an array column with constants, as one codegen'd sum."""
    terms = [F.get(x, F.lit(i)) * F.lit(float(b)) for i, b in enumerate(coefficients) if b]
    return reduce(add, terms, F.lit(0.0))


def hash_share(key: Column, buckets: int = 100) -> Column:
    """0..buckets-1 from the md5 of a key: the same rows on any partitioning or engine."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % buckets
