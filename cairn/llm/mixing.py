"""Mixing sources to target weights by a low-discrepancy schedule (native: DataFrame functions only).

Each source's documents stand in a shuffled line (by md5 of doc_id) of equal blocks of
words; a source that must give more than it has goes through its line again. The
mix's slots are the van der Corput points of its 2^m grid: slot t belongs to the
source whose cumulative share holds the bit-reversed t, so every run of slots is near
the targets. The rank of a slot among its source's slots, counted in closed form over
the dyadic parts of the source's share (no sort, no shuffle), names the block it takes.

Lines are laid out by bucketed running totals, so a source with a third of all rows is
spread over its buckets; slots are dealt out by chunk, blocks by (source, block). Only
the table of sources, one row each, is ordered as a whole.

Edge cases: null text has no words; null source is a source of its own, after the
others; null doc_id sorts by the md5 of 'null'. Documents without words, or of sources
whose target is below their place in line, take 0. Repeated rows stand in line one
after another, ties by doc_id and size. An empty table gives an empty mix; if no text
has a word, all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .env import free, parallelism, row_key, running_total, staged, words_count

WEIGHTS = (5, 2, 1)  # of sources in order, repeating
SHARE = 1.5  # of all words that the mix takes
CAP = 2.0  # times its own size that a source may give
BLOCK_WORDS = 1024
_BUCKET_ROWS, _CHUNK = 1024, 4096
BROADCAST_ROWS = 1_000_000  # places of documents that may be broadcast; beyond, the join shuffles
PART_SLOTS = 2048  # slots in a partition of mixed documents, about


def _order_key(no_id: Column) -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), no_id).cast("binary"))


def sized(docs: DataFrame, by_row: bool = False) -> DataFrame:
    """Staged (_row, doc_id, source, size, _key), the only pass over the texts; by_row adds
    _of, the row's key, by which rows of null doc_id are then shuffled."""
    rows = docs.select("doc_id", "source", words_count(F.col("text")).alias("size"), *([row_key(docs).alias("_of")] if by_row else []))
    rows = rows.withColumn("_key", _order_key(F.col("_of").cast("string") if by_row else F.lit("null")))
    return staged(rows.select(F.monotonically_increasing_id().alias("_row"), "*"), "mix-sizes")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Staged (source, source_size, target), one row a source.

    A source is capped if, with all sources of smaller cap per weight capped, its share
    of the rest reaches its cap; the others split what capped ones leave by weight."""
    one = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(one) - 1) % len(weights) + 1)).withColumn("cap", F.col("source_size") * F.lit(cap))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    per = per.withColumns({
        "rest": F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "w_rest": F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)),
        "place": F.row_number().over(by),
    })
    per = per.withColumn("level", F.col("rest") / F.col("w_rest")).withColumn("capped", F.col("level") * F.col("w") >= F.col("cap"))
    level = F.min_by("level", F.when(~F.col("capped"), F.col("place"))).over(every)
    return staged(per.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * level).alias("target")), "mix-targets")


def in_line(sizes: DataFrame) -> DataFrame:
    """sizes with cum, the words before each document in its source's line."""
    buckets = max(1, -(-sizes.count() // _BUCKET_ROWS))
    at = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    return running_total(sizes, F.col("source"), F.shiftright(at * F.lit(buckets), 32), ["_key", "doc_id", "size", "_row"], F.col("size"), "cum")


def _reversed_bits(x: Column, m: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(x), m, "0")), 2, 10).cast("long")


def _dyadic(x: Column, m: int) -> Column:
    """Parts [p, p + 2^j) of [0, x), one for each set bit j, as structs (c: reversed p, step: 2^(m-j), n: 2^j)."""
    parts = F.filter(F.sequence(F.lit(0), F.lit(m)), lambda j: F.expr("1L").bitwiseAND(F.call_function("shiftright", x, j)) == 1)
    start = lambda j: F.call_function("shiftleft", F.call_function("shiftright", x, j + 1), j + 1)
    return F.transform(parts, lambda j: F.struct(
        _reversed_bits(start(j), m).alias("c"), F.call_function("shiftleft", F.expr("1L"), F.lit(m) - j).alias("step"), F.call_function("shiftleft", F.expr("1L"), j).alias("n")))


def _below(parts: Column, t: Column) -> Column:
    """Points of the parts whose reversed value is below t."""
    one = lambda p: F.greatest(F.lit(0).cast("long"), F.least(p["n"], F.floor((t - p["c"] + p["step"] - 1) / p["step"]).cast("long")))
    return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc + one(p))


def schedule(per_source: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(source, source_size, target) to (slot, source, block, words): slots in mix order.
    Of a source's blocks, numbered through all its passes, each has one slot."""
    spark = per_source.sparkSession
    per = per_source.withColumn("words", F.floor("target").cast("long")).withColumn("n", F.ceil(F.col("words") / block_words).cast("long"))
    total = per.agg(F.sum("n")).first()[0] or 0
    m = max(1, int(total).bit_length())
    per = per.withColumn("a", F.coalesce(F.sum("n").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    chunks = per.filter("n > 0").withColumn("x0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_CHUNK).cast("long")))).repartition(parallelism(spark), "a", "x0")
    cut = chunks.withColumns({"lo": _dyadic(F.col("a"), m), "hi": _dyadic(F.col("a") + F.col("n"), m)})
    slots = cut.withColumn("x", F.explode(F.sequence(F.col("x0"), F.least(F.col("x0") + _CHUNK, F.col("n")) - 1))).withColumn("slot", _reversed_bits(F.col("a") + F.col("x"), m))
    slots = slots.withColumn("block", _below(F.col("hi"), F.col("slot")) - _below(F.col("lo"), F.col("slot")))
    return slots.select("slot", "source", "block", F.least(F.lit(block_words).cast("long"), F.col("words") - F.col("block") * block_words).alias("words"))


def _pieces(lines: DataFrame, cap: float) -> DataFrame:
    """The words [from, to) of its source's blocks that each pass takes of a document."""
    passes = range(int(-(-cap // 1)))
    pieces = lines.filter("size > 0").withColumn("p", F.explode(F.array(*[F.lit(p).cast("long") for p in passes])))
    return pieces.withColumn("from", F.col("p") * F.col("source_size") + F.col("cum")).withColumn("to", F.least(F.col("from") + F.col("size"), F.floor("target").cast("long"))).filter(F.col("from") < F.col("to"))


def _block(word: Column, block_words: int) -> Column:
    return F.call_function("div", word, F.lit(block_words).cast("long"))


def _on_slots(pieces: DataFrame, slots: DataFrame) -> DataFrame:
    # slots grow with the words, but Spark sizes them as the table of sources they are exploded from: never broadcast them
    return pieces.alias("d").join(slots.hint("merge").alias("s"), (F.col("d.source").eqNullSafe(F.col("s.source"))) & (F.col("d.block") == F.col("s.block")))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mix and the documents' lines.

    Mix rows (slot, source, block, _row, doc_id, word_from, word_to): read by slot, they
    are the training sequence, as word ranges of documents. Lines: (_row, doc_id, source, size, cum, source_size, target)."""
    sizes = sized(docs)
    per = targets(sizes, weights, share, cap)
    lines = staged(in_line(sizes), "mix-lines").alias("d").join(per.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d._row", "d.doc_id", "d.source", "d.size", "d.cum", "s.source_size", "s.target")
    pieces = _pieces(lines, cap).withColumn("block", F.explode(F.sequence(_block(F.col("from"), block_words), _block(F.col("to") - 1, block_words))))
    rows = _on_slots(pieces, schedule(per, block_words))
    start = F.col("d.block") * block_words
    cut = lambda x: x - F.col("from")
    return rows.select("s.slot", "d.source", "d.block", "d._row", "d.doc_id", cut(F.greatest(F.col("from"), start)).alias("word_from"), cut(F.least(F.col("to"), start + F.col("s.words"))).alias("word_to")), lines


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (the words that the mix takes of each document),
    first_slot (of the schedule that has words of it, null if none) and n_pieces (runs of its words in blocks)."""
    rows, lines = mix(docs)
    sums = rows.groupBy("_row").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("t"), F.min("slot").alias("first"), F.count("*").alias("k"))
    out = lines.alias("d").join(sums.alias("m"), F.col("d._row") == F.col("m._row"), "left")
    return out.select("d.doc_id", "d.size", "d.source_size", "d.target", F.coalesce("m.t", F.lit(0)).cast("long").alias("taken"), F.col("m.first").alias("first_slot"), F.coalesce("m.k", F.lit(0)).cast("long").alias("n_pieces"))


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix in whole documents, with the columns of docs, in the order of the schedule:
    each stands, once a pass, in the slot that holds its first word there; within a slot
    by place in line. The order is that of partitions and of rows in them (of part files
    by name, once written). Rows go by key: of rows alike in every column, any serves."""
    sizes = sized(docs, by_row=True)
    per = targets(sizes)
    lines = in_line(sizes).alias("d").join(per.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.*", "s.source_size", "s.target")
    firsts = _pieces(lines, CAP).withColumn("block", _block(F.col("from"), block_words))
    no, of, slot, at, key = free(docs, "_id", "_of", "_slot", "_at", "_mix_key")
    places = staged(_on_slots(firsts, schedule(per, block_words)).select(F.col("d.doc_id").alias("_id"), "d._of", F.col("s.slot").alias("_slot"), F.col("d.from").alias("_at")), "mix-places").toDF(no, of, slot, at)
    count, last = places.agg(F.count("*"), F.max(slot)).first()
    same = F.col("doc_id").eqNullSafe(F.col(no)) & (F.col(key) == F.col(of))
    texts = docs.withColumn(key, row_key(docs))
    copies = staged(sizes.groupBy("doc_id", "_of").agg(F.count("*").alias("k")).filter("k > 1").select(F.col("doc_id").alias("_id"), "_of"), "mix-copies").toDF(no, of)
    if copies.limit(1).count():
        texts = texts.join(copies, same, "left_anti").union(texts.join(copies, same, "left_semi").dropDuplicates(["doc_id", key]))
    out = texts.join(F.broadcast(places) if count <= BROADCAST_ROWS else places, same)
    slots = (last or 0) + 1
    parts = -(-slots // PART_SLOTS)
    # slots are dense all along the grid, so equal runs of them have about equal words
    dealt = out.repartitionById(parts, F.call_function("div", F.col(slot) * parts, F.lit(slots).cast("long")).cast("int")).sortWithinPartitions(slot, at)
    return dealt.select(*[F.col(f"`{c}`") for c in docs.columns])
