"""Cross-tokenizer alignment by byte-owner arrays.

A text with a space before it is encoded by a byte-level BPE (A) and by a sentencepiece
model (B, which adds that space itself). np.repeat writes every token's number over its
bytes, once for A and once for B: where either owner changes, a new overlapping pair of
tokens (a link) begins, and where both change at once, a new group of tokens that cover the
same bytes.

Link statistics are corpus-wide. A task aligns blocks of BLOCK_CHARS and leaves, for each
block, the distinct id pairs with the number of documents that hold them, and each
document's pairs as places in that list. Pairs are summed over blocks, so a pair that every
document holds has one row a block, and each block gets its own pairs' totals back. Blocks
are rows of a staged table: a lost executor's are written again.

Words between single spaces are encoded once by B and kept, in each Python worker twice
CACHE_WORDS at most: its vocabulary has spaces only in front of a piece (checked), so no merge
crosses from one such word into the next.

Edge cases: a text that is null, empty, or not the concatenation of its tokens' bytes (as with
U+2581, which B reads as a space) has no tokens, zeros, and an empty string for the digest. The
strings of special tokens in a text are plain text. Rows of equal or null doc_id are
documents of their own. Other columns are left out by link_summary, and pass through align. An empty table
gives no rows; a very long text is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .bpe import _SPACE, Bpe, vocab_path
from .coded import Recent, distinct, flat_bytes, lay, per_text, slices, spread
from .env import give_back, ship, staged

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_CHARS = 2_000_000  # of texts that are aligned together
SHOWN = 1 << 18  # tokens that are written out together
CACHE_WORDS = 100_000  # in each of two generations
SPACE = "▁"  # stands for a space in B's pieces


class PlainBpe(Bpe):
    """A, with the strings of special tokens as plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.special, self.cut, self.odd = {}, None, _SPACE + "{2}"


class Pieces:
    """B, by words."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        # only then do words encode alone
        self.by_word = not any(SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) and p.strip(SPACE) for p in pieces) and sp.piece_to_id(SPACE) != sp.unk_id()
        self.known = Recent(CACHE_WORDS)
        self.lone = np.array([sp.piece_to_id(SPACE)], np.int32).tobytes()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, np.int32).tobytes() for x in self.sp.encode(texts, num_threads=1)] if texts else []

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        odd = pc.match_substring_regex(texts, "^ |  |" + SPACE) if self.by_word else pa.array([True] * len(texts))
        odd = odd.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        offsets = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int64)
        codes, keys = distinct(lists.flatten())
        new = sorted(self.known.missing(keys))
        self.known.now.update(zip(new, [own if key else self.lone for key, own in zip(new, self._encode([k.decode() for k in new]), strict=True)], strict=True))
        table = [self.known.now[k] for k in keys]
        self.known.trim()
        flat, each = spread(codes, table, np.int32)
        n = per_text(each, offsets)
        n[pc.equal(texts.filter(pa.array(~odd)), "").to_numpy(zero_copy_only=False)] = 0
        if odd.any():
            others, rows = iter([np.frombuffer(x, np.int32) for x in self._encode(texts.filter(pa.array(odd)).to_pylist())]), iter(np.split(flat, np.cumsum(per_text(each, offsets))[:-1]))
            whole = [next(others) if o else next(rows) for o in odd]
            total = np.zeros(len(odd), np.int64)
            total[~odd], total[odd] = n, [len(x) for x, o in zip(whole, odd, strict=True) if o]
            return np.concatenate([x[:k] for x, k in zip(whole, total, strict=True)]), total
        keep = np.repeat(n > 0, per_text(each, offsets))
        return flat[keep], n


class Table:
    """Tokens' bytes end to end, and how many each has."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.flat, self.size = np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int64, len(tokens))

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return lay(ids, self.flat, self.size)[0]


class Aligner:
    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = PlainBpe(vocab_path(a)), Pieces(vocab_path(b))
        self.of_a, self.of_b = Table(self.a.table), Table(self.b.table)
        # an id's digits with the mark after it: inside a group, or at the end of A's or B's part of it
        self.shown = Table([f"{i}{mark}".encode() for n, marks in ((len(self.a.table), ",|"), (len(self.b.table), ",;")) for i in range(n) for mark in marks])

    def align(self, texts: pa.Array) -> Aligned:
        """Texts without nulls."""
        spaced = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)))
        data, offsets = flat_bytes(spaced)
        found = [*self.a.encode_array(spaced), *self.b.encode_array(texts)]
        ok = np.ones(len(texts), bool)
        for (ids, n), table in ((found[:2], self.of_a), (found[2:], self.of_b)):
            ok &= per_text(table.size[ids], np.r_[0, np.cumsum(n)]) == np.diff(offsets)
        for (ids, n), table in ((found[:2], self.of_a), (found[2:], self.of_b)):
            now = ok.copy()
            differs = np.flatnonzero(table.bytes_of(ids[np.repeat(now, n)]) != data[np.repeat(now, np.diff(offsets))])
            ends = np.cumsum(np.where(now, np.diff(offsets), 0))
            ok[np.searchsorted(ends, np.unique(differs), "right")] = False
        keep = lambda ids, n: (ids[np.repeat(ok, n)].astype(np.int64), np.where(ok, n, 0))
        return Aligned(self, np.where(ok, np.diff(offsets), 0), *keep(*found[:2]), *keep(*found[2:]))


class Aligned:
    """Both encodings of texts: ids end to end, and how many each text has."""

    def __init__(self, own: Aligner, size: np.ndarray, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        self.own, self.a, self.b, self.n_a, self.n_b = own, a, b, n_a, n_b
        bytes_a, bytes_b = own.of_a.size[a], own.of_b.size[b]
        owner_a, owner_b = np.repeat(np.arange(len(a), dtype=np.int32), bytes_a), np.repeat(np.arange(len(b), dtype=np.int32), bytes_b)
        first = np.ones(min(1, len(owner_a)), bool)
        new_a, new_b = np.r_[first, owner_a[1:] != owner_a[:-1]], np.r_[first, owner_b[1:] != owner_b[:-1]]
        links, cuts = np.flatnonzero(new_a | new_b), np.flatnonzero(new_a & new_b)
        self.link_a, self.link_b = a[owner_a[links]], b[owner_b[links]]
        ends = np.cumsum(size)
        within = lambda at: np.diff(np.r_[0, np.searchsorted(at, ends)])
        self.n_links, self.n_groups = within(links), within(cuts)
        group = lambda n: np.searchsorted(cuts, np.cumsum(n) - n, "right") - 1
        self.group_a, self.group_b, self.groups = group(bytes_a), group(bytes_b), len(cuts)

    def shown(self) -> list[str]:
        """Hex sha256 of each text's groups written out; empty without tokens."""
        per_a, per_b = np.bincount(self.group_a, minlength=self.groups), np.bincount(self.group_b, minlength=self.groups)
        end_a, end_b = np.cumsum(per_a), np.cumsum(per_b)
        place_a, place_b = np.arange(len(self.a)), np.arange(len(self.b))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[place_a + (end_b - per_b)[self.group_a]] = 2 * self.a + (place_a + 1 == end_a[self.group_a])
        codes[place_b + end_a[self.group_b]] = 2 * (len(self.own.of_a.size) + self.b) + (place_b + 1 == end_b[self.group_b])
        ends = np.cumsum(self.n_a + self.n_b)
        out, text, hashed = [], 0, hashlib.sha256()
        for at in range(0, len(codes), SHOWN):
            flat, each = lay(codes[at:at + SHOWN], self.own.shown.flat, self.own.shown.size)
            stop, begun = np.r_[0, np.cumsum(each)], 0
            while text < len(ends) and ends[text] <= at + len(each):
                now = int(stop[max(ends[text] - at, 0)])
                hashed.update(flat[begun:max(now - 1, begun)])
                out.append(hashed.hexdigest() if self.n_a[text] else "")
                begun, text, hashed = now, text + 1, hashlib.sha256()
            hashed.update(flat[begun:])
        return out + [""] * (len(ends) - len(out))


_loaded: dict[tuple[str, str], Aligner] = {}


def loaded(a: str, b: str) -> Aligner:
    if (a, b) not in _loaded:
        _loaded[a, b] = Aligner(a, b)
    return _loaded[a, b]


def align(docs: DataFrame, text: str = "text", out: str = "groups", a: str = A, b: str = B) -> DataFrame:
    """Adds array<struct<a: array<int>, b: array<int>>>: the ids of each group."""
    ship(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        found = []
        for some in slices(texts, BLOCK_CHARS):
            x = loaded(a, b).align(some)
            side = lambda ids, group: pa.ListArray.from_arrays(pa.array(np.searchsorted(group, np.arange(x.groups + 1)), pa.int32()), pa.array(ids, pa.int32()))  # noqa: B023, E731
            both = pa.StructArray.from_arrays([side(x.a, x.group_a), side(x.b, x.group_b)], ["a", "b"])
            found.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(x.n_groups)], pa.int32()), both))
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))

    return docs.withColumn(out, F.arrow_udf(run, "array<struct<a:array<int>,b:array<int>>>")(F.col(f"`{text}`")))


#: What a block says of each of its documents, beside doc_id.
PER_DOC = {"n_a": LongType(), "n_b": LongType(), "n_groups": LongType(), "n_links": LongType(), "groups_sha256": StringType(), "n_pairs": IntegerType()}
#: Its distinct pairs (a << 32 | b) and their documents; then, document by document, places of pairs in that list, and how many links each is.
PER_BLOCK = {"pair": LongType(), "n_docs": IntegerType(), "place": IntegerType(), "links": IntegerType()}


def _block(x: Aligned) -> dict[str, np.ndarray | list]:
    pair, code = np.unique(x.link_a << 32 | x.link_b, return_inverse=True)
    text = np.repeat(np.arange(len(x.n_links)), x.n_links)
    held, links = np.unique(text * max(len(pair), 1) + code, return_counts=True)
    of, place = held // max(len(pair), 1), held % max(len(pair), 1)
    return {"n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups, "n_links": x.n_links, "groups_sha256": x.shown(), "n_pairs": np.bincount(of, minlength=len(x.n_links)),
            "pair": pair, "n_docs": np.bincount(place, minlength=len(pair)), "place": place, "links": links}


def aligned_blocks(docs: DataFrame, text: str = "text", a: str = A, b: str = B) -> DataFrame:
    """Staged, one row a block: block, doc_id and the columns above, all arrays."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    schema = StructType([StructField("doc_id", ArrayType(rows.schema["doc_id"].dataType)), *[StructField(k, ArrayType(t)) for k, t in (PER_DOC | PER_BLOCK).items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {LongType(): pa.int64(), IntegerType(): pa.int32(), StringType(): pa.string()}
        for batch in batches:
            at, ids = 0, batch.column(0)
            for some in slices(batch.column(1), BLOCK_CHARS):
                found = _block(loaded(a, b).align(some))
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([one(ids.slice(at, len(some))), *[one(pa.array(found[k], kinds[t])) for k, t in (PER_DOC | PER_BLOCK).items()]], schema.names)
                at += len(some)
        give_back()

    return staged(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "align-blocks", compression="zstd")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n: documents that hold the pair linked, best: whether no pair of its A id has more)."""
    counts = blocks.select(F.inline(F.arrays_zip("pair", "n_docs"))).groupBy("pair").agg(F.sum("n_docs").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))  # as many rows as B has ids, at most
    return counts.withColumn("best", F.col("n") == most)


def link_summary(docs: DataFrame, text: str = "text", a: str = A, b: str = B) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = aligned_blocks(docs, text, a, b)
    each = blocks.select("block", F.posexplode("pair").alias("i", "pair")).join(pair_counts(blocks), "pair")
    totals = each.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("i", "n", "best"))).alias("t")).select("block", F.col("t.n").alias("n"), F.col("t.best").alias("best"))
    own = blocks.drop("pair", "n_docs").join(totals, "block", "left")  # a block without pairs has no totals
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = blocks.schema["doc_id"].dataType.elementType
    schema = StructType([StructField("doc_id", kind), *[StructField(k, PER_DOC[k]) for k in names[1:]], StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                flat = lambda name: row.column(name).flatten()  # noqa: B023, E731
                numbers = lambda name: flat(name).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.r_[0, np.cumsum(numbers("n_pairs"))]
                links, place = numbers("links"), numbers("place")
                sums = [per_text(links * numbers(name)[place], ends) if len(place) else np.zeros(len(ends) - 1, np.int64) for name in ("best", "n")]
                yield pa.RecordBatch.from_arrays([*[flat(name) for name in names], *[pa.array(s, pa.int64()) for s in sums]], schema.names)
        give_back()

    return own.mapInArrow(run, schema)
