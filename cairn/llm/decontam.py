"""Benchmark decontamination by a prefix-filtered set join (native: DataFrame functions only).

An item's windows are its runs of WINDOW words (a shorter item is one window). A window is
held as its shingles of SHINGLE words, each with its place in the window, ordered by how
often the corpus has them. Of a window of m shingles, of which ceil(share m) must stand at
their places in a document, one of the m - ceil(share m) + 1 rarest does: those are the
prefix, and only they are joined, on their 64-bit hash. Of what joins, the place in the
window says where in the document the window would stand (the positional bound), a
window must end inside the document (the length bound), and then it is compared: with
share 1 by the sha256 of all its words, else shingle by shingle.

The corpus is split into words once, in blocks of BLOCK words that reach over their edges
by what a window needs, so no row is longer for a longer document. It is passed twice: to
count the shingles that the benchmark has, and to join the prefixes. What is broadcast has
rows of fixed width and is measured first; a benchmark too large for one broadcast is
taken in parts of at most BROADCAST_BYTES, one pass each. So documents are never shuffled
for a frequent shingle, and only matches are.

Edge cases: null texts have no words and null or wordless items no windows. Rows of equal or null
doc_id are documents of their own. Items of equal id are one item; one of null id hits
words but is neither named nor counted. Extra columns of either table are left out, so
their names cannot clash. Without benchmark or matches all documents are clean; an empty
table of documents gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .env import staged

#: Runs of ASCII letters and digits and of anything beyond ASCII, after lower-casing A to Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW, SHINGLE = 10, 5
BLOCK = 4096  # words of a document in one row
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 128  # of a row's numbers in a broadcast, with its overhead


def words(text: Column) -> Column:
    """Array of the words of a text. Only A to Z change case; lower() does no more on a text that is all ASCII, and is faster."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def word_blocks(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Staged (row, doc_id, n, block, at, words): block numbers a document's blocks, words
    begins at word `at` of its n, up to `window` words before the block's own and ends as many after."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col(f"`{text}`")).alias("w")).withColumn("n", F.size("w"))
    first = lambda b: F.greatest(F.lit(0), b * BLOCK - window)
    cut = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / BLOCK).cast("int")),
                      lambda b: F.struct(b.alias("block"), first(b).alias("at"), F.slice("w", first(b) + 1, (b + 1) * BLOCK + window - first(b)).alias("words")))
    return staged(rows.select("row", "doc_id", "n", F.explode(cut).alias("c")).select("row", "doc_id", "n", "c.*"), "word-blocks")


def shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(size)])


def _shingles(blocks: DataFrame, size: int) -> DataFrame:
    """(row, at, words, p, h): the shingle of that size at each own place p of a block's words."""
    first, last = F.col("block") * BLOCK - F.col("at"), F.least((F.col("block") + 1) * BLOCK, F.col("n") - (size - 1)) - F.col("at") - 1
    places = blocks.select("row", "at", "words", F.explode(F.when(first <= last, F.sequence(first, last))).alias("p"))
    return places.withColumn("h", shingle(F.col("words"), F.col("p"), size))


def item_windows(benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE, item: str = "item_id", text: str = "text") -> DataFrame:
    """Staged (item: string, k: words, s: shingle size, key: sha256 of the words, hs: shingles by place)."""
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("w")).withColumn("n", F.size("w")).filter("n > 0")
    k = F.least("n", F.lit(window))
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: F.slice("w", i + 1, k))
    rows = rows.select("item", F.explode(cut).alias("w")).withColumn("k", F.size("w")).withColumn("s", F.least("k", F.lit(size)))
    hs = reduce(lambda rest, s: F.when(F.col("s") == s, F.transform(F.sequence(F.lit(0), F.col("k") - s), lambda o: shingle(F.col("w"), o, s))).otherwise(rest), range(1, size + 1), F.lit(None))
    return staged(rows.select("item", "k", "s", F.sha2(F.array_join("w", " "), 256).alias("key"), hs.alias("hs")).distinct(), "item-windows")


def in_parts(df: DataFrame, bound: int = BROADCAST_BYTES) -> list[DataFrame]:
    """Parts of a staged table, by hash, each measured to be within the bound, for broadcasts."""
    size = reduce(lambda a, f: a + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)), [f for f in df.schema if isinstance(f.dataType, StringType)], F.lit(ROW_BYTES))
    size = size + reduce(lambda a, f: a + 8 * F.greatest(F.size(f.name), F.lit(0)), [f for f in df.schema if f.dataType.typeName() == "array"], F.lit(0))
    of = lambda n: F.pmod(F.xxhash64(*df.columns), F.lit(n))
    n, rows, total = 1, *(x or 0 for x in df.agg(F.count("*"), F.sum(size)).first())
    while total > n * bound or n > 1 and df.groupBy(of(n)).agg(F.sum(size).alias("b")).agg(F.max("b")).first()[0] > bound:
        if n > rows:
            raise ValueError(f"a single row exceeds {bound} bytes")
        n = max(2 * n, total // bound + 1)
    return [df.filter(of(n) == i) for i in range(n)] if n > 1 else [df]


def _joined(left: DataFrame, right: DataFrame, on, bound: int, how: str = "inner") -> DataFrame:
    """Inner (or semi) join with a staged table by measured broadcasts; a row of right is in one part only, and for a semi join no two rows are equal on the key."""
    return reduce(DataFrame.unionByName, [left.join(F.broadcast(part), on, how) for part in in_parts(right, bound)])


def prefixes(blocks: DataFrame, windows: DataFrame, sizes: list[int], share: float = 1.0, bound: int = BROADCAST_BYTES) -> DataFrame:
    """Staged (s, h, o, k, key, hs, need): the prefix of every window that the corpus may hold, o being the shingle's place."""
    each = windows.select("key", "k", "s", "hs").distinct().select("*", F.posexplode("hs").alias("o", "h"))
    known = staged(each.select("s", "h").distinct(), "item-shingles")
    counts = [_joined(_shingles(blocks, s).select("h"), known.filter(F.col("s") == s).select("h"), "h", bound, "left_semi").groupBy("h").agg(F.count("*").alias("n")).withColumn("s", F.lit(s)) for s in sizes]
    counted = each.join(reduce(DataFrame.unionByName, counts), ["s", "h"], "left").fillna(0, ["n"])
    need = F.ceil(F.size("hs") * F.lit(share)).cast("int")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("n", "h", "o"))
    kept = counted.withColumns({"need": need, "r": rank}).filter((F.col("r") <= F.size("hs") - F.col("need") + 1) & (F.col("n") > 0))
    return staged(kept.select("s", "h", "o", "k", "key", "hs" if share < 1 else F.array().cast("array<long>").alias("hs"), "need"), "prefixes")


def matches(blocks: DataFrame, windows: DataFrame, share: float = 1.0, bound: int = BROADCAST_BYTES) -> DataFrame:
    """Staged (row, start, k, key): the places in documents where windows stand."""
    sizes = sorted(r.s for r in windows.select("s").distinct().collect())  # SHINGLE numbers at most
    found = [blocks.limit(0).select("row", F.lit(0).alias("start"), F.lit(0).alias("k"), F.lit("").alias("key"))]
    ahead = prefixes(blocks, windows, sizes, share, bound) if sizes else None
    for s in sizes:
        both = _joined(_shingles(blocks, s), ahead.filter(F.col("s") == s).drop("s"), "h", bound)
        start, held = F.col("p") - F.col("o"), F.col("words")
        both = both.withColumn("q", start).filter((F.col("q") >= 0) & (F.col("q") + F.col("k") <= F.size(held)))
        if share < 1:
            equal = F.filter(F.sequence(F.lit(0), F.col("k") - s), lambda j: shingle(held, F.col("q") + j, s) == F.get("hs", j))  # noqa: B023
            both = both.filter(F.size(equal) >= F.col("need"))
        else:
            both = both.filter(F.sha2(F.array_join(F.slice(held, F.col("q") + 1, F.col("k")), " "), 256) == F.col("key"))
        found.append(both.select("row", (F.col("at") + F.col("q")).alias("start"), "k", "key"))
    out = reduce(DataFrame.unionByName, found)
    return staged(out.distinct() if share < 1 else out, "item-matches")


def _spans(found: DataFrame) -> DataFrame:
    """(row, n_hit, spans): the union of the places of a document's windows."""
    inside = Window.partitionBy("row").orderBy("start", "end")
    runs = found.select("row", "start", (F.col("start") + F.col("k")).alias("end")).withColumn("far", F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    runs = runs.withColumn("run", F.sum(F.when(F.col("start") <= F.col("far"), 0).otherwise(1)).over(inside))
    runs = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, size: int = SHINGLE, share: float = 1.0, text: str = "text", bound: int = BROADCAST_BYTES) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, spans (start and end of runs of hit
    words, counted in words) and items (ids, as strings and so sorted, of items with a window in it)."""
    blocks, windows = word_blocks(docs, text, window), item_windows(benchmark, window, size)
    found = matches(blocks, windows, share, bound)
    named = staged(windows.filter("item is not null").select("key", "item").distinct(), "item-keys")
    items = _joined(found.select("row", "key").distinct(), named, "key", bound).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    every = blocks.filter("block = 0").select("row", "doc_id", F.col("n").cast("long").alias("n_words"))
    out = every.join(_spans(found), "row", "left").join(items, "row", "left")
    empty = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), empty("spans", "array<struct<start:int,end:int>>"), empty("items", "array<string>"))
