"""Joins and frames in event time: as-of and interval joins, sessions, neighbours, trailing sums.

All of them cut a key's rows into slices of time, work inside slices, and hand over what a
slice leaves (its last value, its totals) by a table of one row a slice. So a key with a
third of all rows is spread over as many tasks as it has slices, and nothing but that small
table is ever ordered over a key's whole history. Times are compared in microseconds.

Rows with a null key or time match nothing and get nulls; they stay in the result of every
operator but the inner interval join. Ties in time stand in the order of the columns of tie.
Inputs keep all their columns; an output column must not have a name that is taken.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
MICROS = 1_000_000


def micros(c: Column) -> Column:
    """Microseconds since the epoch of a timestamp (one without a zone is read in the session's)."""
    return F.unix_micros(c.cast("timestamp"))


def _packed(df: DataFrame, on: list[str], time: str, seconds: int, tie: list[str] = (), name: str = "_row") -> DataFrame:
    """(_k0.., _t, _s: slice, _o: tie, and the whole row as a struct): names of df cannot clash."""
    t = micros(F.col(f"`{time}`"))
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(on)]
    rows = df.select(*keys, t.alias("_t"), F.floor(t / (seconds * MICROS)).alias("_s"), F.struct(F.lit(0), *[F.col(f"`{c}`") for c in tie]).alias("_o"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    return rows


def _keys(on: list[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(on))]


def _whole(on: list[str]) -> Column:
    """Neither key nor time is null."""
    return reduce(and_, [F.col(c).isNotNull() for c in [*_keys(on), "_t"]])


def _same(a: str, b: str, cols: list[str]) -> list[Column]:
    return [F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in cols]


def _over_slices(per_slice: DataFrame, on: list[str], **out: tuple[Column, bool]) -> DataFrame:
    """per_slice with, by name, an aggregate over the key's slices before (or, if False, after) each: one row a slice."""
    w = Window.partitionBy(*_keys(on)).orderBy("_s")
    frames = {True: w.rowsBetween(Window.unboundedPreceding, -1), False: w.rowsBetween(1, Window.unboundedFollowing)}
    return per_slice.select(*_keys(on), "_s", *[c.over(frames[before]).alias(name) for name, (c, before) in out.items()])


def _with_carry(rows: DataFrame, carry: DataFrame, on: list[str], names: list[str]) -> DataFrame:
    joined = rows.alias("r").join(carry.alias("c"), _same("r", "c", [*_keys(on), "_s"]), "left")
    return joined.select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"c.{n}") for n in names])


def _back(rows: DataFrame, lost: DataFrame, df: DataFrame, **out: Column) -> DataFrame:
    """The packed rows unpacked, with the new columns; the lost ones have nulls there."""
    kinds = rows.select(*[c.alias(n) for n, c in out.items()]).schema
    whole = rows.select(*[F.col(f"_row.`{c}`") for c in df.columns], *[c.alias(n) for n, c in out.items()])
    return whole.unionByName(lost.select(*[F.col(f"_row.`{c}`") for c in df.columns], *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]))


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], prefix: str = "last_", strict: bool = True, tie: list[str] = (), within: int | None = None, slice_seconds: int = DAY) -> DataFrame:
    """Every left row with the values and the time of the last right row of its keys before
    it (or, unless strict, at its time), and {prefix}age in seconds. Of right rows of
    one time, the last in the order of tie counts. within: the greatest age in seconds."""
    rows = _packed(left, on, left_time, slice_seconds).withColumn("_side", F.lit(0 if strict else 1))
    found = F.struct(F.col("_t").alias("t"), F.struct(*[F.col(f"_right.`{c}`") for c in values]).alias("v"))
    ticks = _packed(right, on, right_time, slice_seconds, tie, "_right").filter(_whole(on)).withColumn("_side", F.lit(1 if strict else 0)).withColumn("_found", found).drop("_right")
    # both sides in one table, that one sort of a slice merges by time
    both = rows.filter(_whole(on)).drop("_o").unionByName(ticks, allowMissingColumns=True).repartition(*_keys(on), "_s")
    w = Window.partitionBy(*_keys(on), "_s").orderBy("_t", "_side", "_o")
    inside = both.withColumn("_in", F.last("_found", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_row is not null")
    per_slice = both.groupBy(*_keys(on), "_s").agg(F.max_by("_found", F.when(F.col("_found").isNotNull(), F.struct("_t", "_o"))).alias("_last"))
    carry = _over_slices(per_slice, on, _before=(F.last("_last", ignorenulls=True), True))
    best = F.coalesce("_in", "_before")
    joined = _with_carry(inside.select(*_keys(on), "_s", "_t", "_row", "_in"), carry, on, ["_before"]).withColumn("_best", best)
    age = (F.col("_t") - F.col("_best.t")) / MICROS
    if within is not None:
        joined = joined.withColumn("_best", F.when(age <= within, F.col("_best")))
    kept = {f"{prefix}{c}": F.col(f"_best.v.`{c}`") for c in values}
    return _back(joined, rows.filter(~_whole(on)), left, **kept, **{f"{prefix}time": F.timestamp_micros("_best.t"), f"{prefix}age": age})


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, seconds: float, fineness: int = 1, prefix: str = "right_") -> DataFrame:
    """All pairs in which the right row's time is at most so many seconds before the left's, or
    equal; the right columns' names get the prefix. A right row is laid into the bins of time it
    can meet, fineness + 1 of them, so this is an equi-join with an exact test. A finer bin
    spreads a hot key over more tasks."""
    reach = round(seconds * MICROS)
    width = max(1, reach // fineness)
    a = _packed(left, on, left_time, DAY).filter(_whole(on)).withColumn("_bin", F.floor(F.col("_t") / width))
    b = _packed(right, on, right_time, DAY, name="_right").filter(_whole(on))
    b = b.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_t") / width), F.floor((F.col("_t") + reach) / width))))
    both = a.alias("a").join(b.alias("b"), [*_same("a", "b", [*_keys(on), "_bin"]), F.col("a._t") - F.col("b._t") >= 0, F.col("a._t") - F.col("b._t") <= reach])
    return both.select(*[F.col(f"a._row.`{c}`") for c in left.columns], *[F.col(f"b._right.`{c}`").alias(f"{prefix}{c}") for c in right.columns])


def sessionize(events: DataFrame, on: list[str], time: str, gap_seconds: float, out: str = "session_start", slice_seconds: int = DAY) -> DataFrame:
    """Adds the time at which the row's session began: a row more than the gap after the key's last begins one."""
    packed = _packed(events, on, time, slice_seconds)
    rows = packed.filter(_whole(on)).repartition(*_keys(on), "_s")
    carry = _over_slices(rows.groupBy(*_keys(on), "_s").agg(F.max("_t").alias("_m")), on, _before=(F.max("_m"), True))
    w = Window.partitionBy(*_keys(on), "_s").orderBy("_t")
    before = F.coalesce(F.lag("_t").over(w), F.col("_before"))
    begun = _with_carry(rows, carry, on, ["_before"]).withColumn("_p", before).withColumn("_b", F.when(F.col("_p").isNull() | (F.col("_t") - F.col("_p") > round(gap_seconds * MICROS)), F.col("_t"))).drop("_p", "_before")
    opened = _over_slices(begun.groupBy(*_keys(on), "_s").agg(F.max("_b").alias("_m")), on, _open=(F.max("_m"), True))
    inside = begun.withColumn("_in", F.max("_b").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    start = F.timestamp_micros(F.coalesce("_in", "_open"))
    return _back(_with_carry(inside, opened, on, ["_open"]), packed.filter(~_whole(on)), events, **{out: start})


def neighbours(events: DataFrame, on: list[str], time: str, values: list[str], tie: list[str], slice_seconds: int = DAY) -> DataFrame:
    """Adds previous_ and next_ of each value: those of the key's row before and after in the order of (time, tie)."""
    packed = _packed(events, on, time, slice_seconds, tie).withColumn("_v", F.struct(*[F.col(f"_row.`{c}`") for c in values]))
    rows = packed.filter(_whole(on)).repartition(*_keys(on), "_s")
    order = F.struct("_t", "_o")
    ends = rows.groupBy(*_keys(on), "_s").agg(F.max_by("_v", order).alias("_last"), F.min_by("_v", order).alias("_first"))
    carry = _over_slices(ends, on, _before=(F.last("_last"), True), _after=(F.first("_first"), False))
    w = Window.partitionBy(*_keys(on), "_s").orderBy("_t", "_o")
    inside = rows.withColumns({"_p": F.lag("_v").over(w), "_n": F.lead("_v").over(w)})
    joined = _with_carry(inside, carry, on, ["_before", "_after"]).withColumns({"_p": F.coalesce("_p", "_before"), "_n": F.coalesce("_n", "_after")})
    return _back(joined, packed.filter(~_whole(on)), events, **{f"previous_{c}": F.col(f"_p.`{c}`") for c in values}, **{f"next_{c}": F.col(f"_n.`{c}`") for c in values})


def trailing(events: DataFrame, on: list[str], time: str, value: str, seconds: float, scale: int = 6, slice_seconds: int = DAY) -> DataFrame:
    """Adds trailing_n, trailing_sum and trailing_mean of the value over the key's rows from so many
    seconds before the row to its time, equal times included. Each row enters at its time and
    leaves when it falls out, and the frame is the running total of both: linear in the rows,
    however many the frame holds. Sums are decimals of the scale, so what leaves cancels exactly;
    a null value counts for nothing."""
    packed = _packed(events, on, time, slice_seconds)
    v = F.col(f"_row.`{value}`").cast(f"decimal(38,{scale})")
    rows = packed.filter(_whole(on)).withColumns({"_v": v, "_n": F.when(v.isNotNull(), 1).otherwise(0)})
    out_at = F.col("_t") + (round(seconds * MICROS) + 1)  # the first microsecond in which the row is out
    gone = rows.select(*_keys(on), out_at.alias("_t"), F.floor(out_at / (slice_seconds * MICROS)).alias("_s"), (-F.col("_v")).alias("_v"), (-F.col("_n")).alias("_n"))
    both = rows.unionByName(gone, allowMissingColumns=True).repartition(*_keys(on), "_s")
    sums = both.groupBy(*_keys(on), "_s").agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n"))
    carry = _over_slices(sums, on, _v0=(F.sum("_v"), True), _n0=(F.sum("_n"), True))
    w = Window.partitionBy(*_keys(on), "_s").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)
    inside = both.withColumns({"_v1": F.sum("_v").over(w), "_n1": F.sum("_n").over(w)}).filter("_row is not null")
    zero = F.lit(0)
    joined = _with_carry(inside, carry, on, ["_v0", "_n0"]).withColumns({"_v": F.coalesce("_v0", zero) + F.coalesce("_v1", zero), "_n": F.coalesce("_n0", zero) + F.coalesce("_n1", zero)})
    total = F.when(F.col("_n") > 0, F.col("_v").cast("double"))
    return _back(joined, packed.filter(~_whole(on)), events, trailing_n=F.col("_n"), trailing_sum=total, trailing_mean=total / F.col("_n"))
