"""Splits, samples and caps. The hash-based forms pick the same rows on any partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cairn.functions.columns import hash_share


@contextmanager
def numbered(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """df with a row id that is the same in every pass: the numbered rows are checkpointed in
    the folder of spark.checkpoint.dir, which executors may be lost over, and go with Spark's
    cleaner. Where that is unset, a local session caches them; a cluster, whose caches go with their executors, raises."""
    spark = df.sparkSession
    folder, rows = spark.conf.get("spark.checkpoint.dir", None), df.withColumn(name, F.monotonically_increasing_id())
    if folder:
        spark.sparkContext.setCheckpointDir(folder)
        yield rows.checkpoint()
        return
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    rows = rows.persist(StorageLevel.DISK_ONLY)
    rows.count()
    try:
        yield rows
    finally:
        rows.unpersist()


def random_split(df: DataFrame, rate: float = 0.1, seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    """Train and test by Spark's randomSplit; rows depend on partitioning."""
    train, test = df.randomSplit([1 - rate, rate], seed)
    return train, test


def hash_split(df: DataFrame, key: Column, percent: int = 10) -> tuple[DataFrame, DataFrame]:
    """Train and test by the md5 of a key; one condition each, no shuffle."""
    test = hash_share(key) < percent
    return df.filter(~test), df.filter(test)


def balanced_split(df: DataFrame, label: str, key: Column, rate: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The first `rate` of every class, by hash order, is the test set. Ranks are
    counted inside 1/1024 slices of the hash space, so no class meets in one task; rates hold per slice."""
    w = Window.partitionBy(label, "_slice").orderBy("_h", "_k")
    ranked = df.withColumns({"_k": key.cast("string"), "_h": hash_share(key, 2**32)}).withColumn("_slice", F.shiftright("_h", 22))
    total = F.count("*").over(Window.partitionBy(label, "_slice"))
    marked = ranked.withColumn("_test", F.row_number().over(w) <= F.round(total * rate)).drop("_k", "_h", "_slice")
    return marked.filter(~F.col("_test")).drop("_test"), marked.filter("_test").drop("_test")


def ranked(df: DataFrame, label: str, key: Column) -> DataFrame:
    """df with _rank (from 0, ties share the least) of each row in its class in the order of
    (md5 of key, key), and _size of the class. Rows are ranked inside 1/4096 slices of the md5 space
    and slices are counted, so no class meets in one task."""
    rows = df.withColumns({"_key": key, "_md5": F.md5(key.cast("string").cast("binary"))}).withColumn("_slice", F.coalesce(F.substring("_md5", 1, 3), F.lit("")))
    inside = rows.withColumn("_in", F.rank().over(Window.partitionBy(label, "_slice").orderBy("_md5", "_key")) - 1)
    counts = rows.groupBy(F.col(label).alias("_c"), F.col("_slice").alias("_s")).agg(F.count("*").alias("_k"))
    of_class = Window.partitionBy("_c")  # 4096 rows a class, at most
    counts = counts.withColumn("_before", F.coalesce(F.sum("_k").over(of_class.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_size", F.sum("_k").over(of_class))
    both = inside.join(counts, F.col(label).eqNullSafe(F.col("_c")) & (F.col("_slice") == F.col("_s")))
    return both.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_in")).alias("_rank"), "_size")


def exact_split(df: DataFrame, label: str, key: Column, rate: float = 0.2) -> DataFrame:
    """Adds is_test by percent_rank within the class, in md5 order."""
    share = F.when(F.col("_size") > 1, F.col("_rank") / (F.col("_size") - 1)).otherwise(0.0)
    return ranked(df, label, key).withColumn("is_test", share < rate).drop("_rank", "_size")


def cap_sample(df: DataFrame, size: int, seed: int = 1234) -> DataFrame:
    """A Bernoulli sample of about size rows if there are more."""
    n = df.count()
    return df if n <= size else df.sample(fraction=size / n, seed=seed)


def fraction_sample(df: DataFrame, fraction: float = 0.1, seed: int = 1234) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def cap_classes(df: DataFrame, label: str, ratio: float = 5.0, seed: int = 1234) -> DataFrame:
    """Samples every class down to about ratio times the smallest."""
    counts = {r[label]: r.n for r in class_counts(df, label).collect()}
    if not counts:
        return df
    cap = ratio * min(counts.values())
    return df.sampleBy(label, {k: min(1.0, cap / n) for k, n in counts.items()}, seed)


def cap_classes_exactly(df: DataFrame, label: str, key: Column, ratio: float = 5.0) -> DataFrame:
    """Keeps, of each class, the first ratio times the smallest class in md5 order (ties at the cap stay)."""
    smallest = class_counts(df, label).agg(F.min("n")).first()[0]
    return ranked(df, label, key).filter(F.col("_rank") < int(ratio * (smallest or 0))).drop("_rank", "_size")


def class_weights(df: DataFrame, label: str, scheme: str = "sqrt", out: str = "class_weight") -> DataFrame:
    """g(N / (K n_c)), scaled so that the K weights sum to K; g is sqrt or identity. Rows without a
    class are left out. The counts, one row a class, are fetched, and the weights broadcast: a join dealt by class would have all rows of a class,
    and each later pass over them, in one task."""
    counts = [(r[label], r.n) for r in class_counts(df.filter(F.col(label).isNotNull()), label).collect()]
    raw = [(sum(n for _, n in counts) / (len(counts) * n)) ** (0.5 if scheme == "sqrt" else 1) for _, n in counts]
    kinds = StructType([StructField("_label", df.schema[label].dataType), StructField(out, DoubleType())])
    per = df.sparkSession.createDataFrame([(c, g * len(counts) / sum(raw)) for (c, _), g in zip(counts, raw, strict=True)], kinds)
    return df.join(F.broadcast(per), df[label] == per["_label"]).drop("_label")


EXACT_ROWS = 1_000_000  # values that one percentile aggregate may hold
SKETCH = 10_000  # accuracy of the sketches


def order_statistics(values: DataFrame, ranks: list[int], limit: int = EXACT_ROWS, n: int | None = None) -> dict[int, float]:
    """Exact values at sorted places (from 0) of values (v double, no nulls; n of them, if known),
    which no task has to hold: sketches bracket each place, and only what is inside a bracket is looked at again."""
    n = values.count() if n is None else n
    if n <= limit:
        row = values.agg(F.percentile("v", [r / max(n - 1, 1) for r in ranks]).alias("q")).first()
        return dict(zip(ranks, row.q, strict=True))
    share = lambda x: min(max(x, 0.0), 1.0)
    ends = values.agg(F.percentile_approx("v", [share(r / n + d) for r in ranks for d in (-2 / SKETCH, 2 / SKETCH)], SKETCH).alias("q"), F.min("v").alias("least"), F.max("v").alias("most")).first()
    spans = {}
    for i, r in enumerate(ranks):
        lo, hi = ends.q[2 * i:2 * i + 2]
        spans[r] = ends.least if r / n - 2 / SKETCH <= 0 else lo, ends.most if r / n + 2 / SKETCH >= 1 else hi
    at = values.agg(*[f(F.col("v") < x).alias(f"a{r}_{k}") if k % 2 == 0 else f(F.col("v") <= x).alias(f"a{r}_{k}") for r, (lo, hi) in spans.items() for k, x, f in ((0, lo, F.count_if), (1, lo, F.count_if), (2, hi, F.count_if))]).first()
    out = {}
    for r, (lo, hi) in spans.items():
        below, through, before_hi = (at[f"a{r}_{k}"] for k in range(3))
        if below <= r < through:
            out[r] = lo
        elif r >= before_hi:
            out[r] = hi
        else:
            out |= {r: order_statistics(values.filter((F.col("v") > lo) & (F.col("v") < hi)), [r - through], limit)[r - through]}
    return out


def column_order_statistics(df: DataFrame, ranks: dict[str, list[int]], n: dict[str, int], limit: int | None = None) -> dict[str, dict[int, float]]:
    """order_statistics of several columns (n values of each, nulls apart), all in three passes: sketches of every column, counts
    at every bracket, then the values inside brackets by value. A bracket that holds more than limit different places is narrowed on its own."""
    limit = EXACT_ROWS if limit is None else limit
    v = {c: F.col(f"`{c}`").cast("double") for c in ranks}
    share = lambda x: min(max(x, 0.0), 1.0)
    ends = df.agg(*[x for i, (c, rs) in enumerate(ranks.items()) for x in (F.percentile_approx(v[c], [share(r / n[c] + d) for r in rs for d in (-2 / SKETCH, 2 / SKETCH)], SKETCH).alias(f"q{i}"), F.min(v[c]).alias(f"least{i}"), F.max(v[c]).alias(f"most{i}"))]).first()
    spans = {}
    for i, (c, rs) in enumerate(ranks.items()):
        for j, r in enumerate(rs):
            lo, hi = ends[f"q{i}"][2 * j:2 * j + 2]
            spans[c, r] = ends[f"least{i}"] if r / n[c] - 2 / SKETCH <= 0 else lo, ends[f"most{i}"] if r / n[c] + 2 / SKETCH >= 1 else hi
    at = df.agg(*[F.count_if(test).alias(f"a{k}_{m}") for k, ((c, _), (lo, hi)) in enumerate(spans.items()) for m, test in enumerate((v[c] < lo, v[c] <= lo, v[c] < hi))]).first()
    out: dict[str, dict[int, float]] = {c: {} for c in ranks}
    left = {}  # by its number, a bracket that must be looked into, and the place inside it
    for k, ((c, r), (lo, hi)) in enumerate(spans.items()):
        below, through, before_hi = (at[f"a{k}_{m}"] for m in range(3))
        if below <= r < through:
            out[c][r] = lo
        elif r >= before_hi:
            out[c][r] = hi
        elif before_hi - through > limit:
            inside = df.select(v[c].alias("v")).filter((F.col("v") > lo) & (F.col("v") < hi))
            out[c][r] = order_statistics(inside, [r - through], limit)[r - through]
        else:
            left[k] = (c, r, lo, hi, r - through)
    if left:
        pairs = F.array(*[F.when((v[c] > lo) & (v[c] < hi), F.struct(F.lit(k).alias("k"), v[c].alias("v"))) for k, (c, _, lo, hi, _) in left.items()])
        counts = df.select(F.explode(F.array_compact(pairs)).alias("x")).groupBy("x.k", "x.v").agg(F.count("*").alias("m"))
        place = F.create_map(*[F.lit(x) for k, b in left.items() for x in (k, b[4])])
        through = counts.withColumn("through", F.sum("m").over(Window.partitionBy("k").orderBy("v")))  # of limit rows a bracket, at most
        for row in through.filter(F.col("through") > place[F.col("k")]).groupBy("k").agg(F.min("v").alias("v")).collect():  # one row a bracket
            out[left[row.k][0]][left[row.k][1]] = row.v
    return out


def quantiles(df: DataFrame, col: str, probs: list[float], exact: bool = True, accuracy: int = SKETCH) -> list[float] | None:
    """Interpolated percentiles, exact at any size, or those of sketches; None without values."""
    if not exact:
        return df.agg(F.percentile_approx(col, probs, accuracy).alias("q")).first().q
    values = df.select(F.col(f"`{col}`").cast("double").alias("v")).filter("v is not null")
    return interpolated(values, probs, values.count())


def interpolated(values: DataFrame, probs: list[float], n: int) -> list[float] | None:
    """Interpolated percentiles of n values (v double, no nulls), exact at any size; None without values."""
    if n <= EXACT_ROWS:
        return values.agg(F.percentile("v", probs).alias("q")).first().q
    needed = needed_ranks(probs, n)
    return between_ranks(probs, n, order_statistics(values, needed, n=n))


def needed_ranks(probs: list[float], n: int) -> list[int]:
    """The places on both sides of each percentile of n values."""
    return sorted({r for p in probs for r in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1))})


def between_ranks(probs: list[float], n: int, found: dict[int, float]) -> list[float]:
    places = [p * (n - 1) for p in probs]
    return [found[int(x)] + (x - int(x)) * (found[min(int(x) + 1, n - 1)] - found[int(x)]) for x in places]


def column_percentiles(df: DataFrame, probs: list[float], n: dict[str, int]) -> dict[str, list[float]]:
    """interpolated() of several columns in as many passes as one takes."""
    found = column_order_statistics(df, {c: needed_ranks(probs, k) for c, k in n.items()}, n)
    return {c: between_ranks(probs, k, found[c]) for c, k in n.items()}


def winsorize(df: DataFrame, col: str, lower: float = 0.01, upper: float = 0.99, exact: bool = True) -> DataFrame:
    """Clamps a column to its quantiles; nulls stay."""
    found = quantiles(df, col, [lower, upper], exact)
    if found is None:
        return df
    c = F.col(col)
    return df.withColumn(col, F.when(c < found[0], found[0]).when(c > found[1], found[1]).otherwise(c))
