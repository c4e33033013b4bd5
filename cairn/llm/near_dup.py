"""Exact Jaccard self-join on word shingles by blocked sparse matrix products.

Rows of the incidence matrix are classes of documents with equal shingle sets, columns
64-bit shingle hashes. Two classes link when 100 |A n B| >= 75 |A u B|. Nothing below
is sampled; each step drops only what a size-derived bound rules out. So results are exact up to
collisions of those hashes (of 40 bits and a column block in step 2, where one may keep a class too many, but drops none):

1. Classes: every text is hashed once to (set size, set hash); copies meet there.
2. Shared counts: a linked set of n has at most floor(n/4) shingles that no other class
   has. Over the shingles of even hash, blocks of documents send each distinct hash
   once to its column block, which returns how many of a class's are shared; classes
   with more than floor(n/4) unshared ones cannot link. Other texts end here.
3. Order: for the rest, column blocks return document frequencies; a class's prefix is
   its floor(n/4) + 1 rarest shingles, and linked classes share one of their prefixes.
4. Prefix sharing ties candidates into groups (stars, then components).
5. Products: groups are packed into tiles of classes, bounded by their rows and by their
   shingles, so in bytes. A tile's rows are all multiplied
   with each other: wide columns as dense blocks, the others through posting lists. A
   group beyond a tile is cut by set size into bands of ratio 4/3, and those into tiles;
   tiles of one band or of bands side by side are multiplied, as sizes rule out all others.
   Out of a product come, of each row, the number of documents that it links to and a
   link to the least row of its component there; pairs are counted, not written out.
6. Components of the links; a document's is named by its smallest doc_id. Its n_links
   are the other documents that are alike: the rest of its class, and linked classes.

Edge cases: null, empty or blank text has no shingles and its own doc_id as component.
Texts of one to four words have one shingle, the whole sequence. Rows of null doc_id
take part, and are named by their component's smallest doc_id (null if it has none).
Rows of equal doc_id and different texts name their components by the same id but
are not linked by it. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coded import distinct, slices, split_words
from .env import free, give_back, row_key, ship, staged
from .graph import components

WORDS = 5
NUM, DEN = 75, 100  # least similarity
BLOCK_CHARS = 4_000_000  # of text in a block of rows
BLOCK_COLUMNS = 1_000_000  # shingles in a column block, about
TILE = 2048  # rows in a product, about
TILE_SHINGLES = 6_000_000  # and shingles
BIN = 0.5  # of a product's rows or shingles in a tile of small groups, about
DENSE = 16  # columns of more than one in so many rows of a tile are multiplied as dense ones
CELLS = 1_000_000  # of a product that are held at once, about
BROADCAST_ROWS = 1_000_000  # survivors that may be broadcast; beyond, the join shuffles

_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def tidy(f):
    """f on a group's table; what it freed goes back to the system."""

    def run(table: pa.Table) -> pa.Table:
        try:
            return f(table)
        finally:
            give_back()

    return run


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its shingles. Only A-Z is lowered."""
    import xxhash

    out: list[np.ndarray] = []
    for some in slices(texts):
        words, offsets = split_words(pc.ascii_lower(some))
        codes, keys = distinct(words)
        ids = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))[codes]
        real = (np.fromiter(map(len, keys), np.int64, len(keys)) > 0)[codes]
        if not real.all():
            offsets = np.r_[0, np.cumsum(real)][offsets]
            ids = ids[real]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if a == b:
                out.append(np.zeros(0, np.uint64))
                continue
            size = min(WORDS, b - a)
            h = np.zeros(b - a - size + 1, np.uint64)
            for i in range(size):
                h = h * _P + ids[a + i:b - size + 1 + i]
            out.append(np.unique(_mix(h + np.uint64(size))))
    return out


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit hash of a set; 0 only for the empty one, in practice."""
    if not len(s):
        return 0
    both = np.array([s.sum(), np.bitwise_xor.reduce(_mix(s))], np.uint64)
    return int(_mix(both[:1] * _P + both[1:] + np.uint64(len(s))).view(np.int64)[0])


def slack(n: int) -> int:
    """Most shingles of a set of n that a linked set may lack."""
    return n - -(-NUM * n // DEN)


def _chunks(batches: Iterator[pa.RecordBatch], text: int, chars: int = BLOCK_CHARS):
    """Row slices of bounded text."""
    for b in batches:
        start = size = 0
        lengths = pc.binary_length(b.column(text)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            size += n
            if size >= chars:
                yield b.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < b.num_rows:
            yield b.slice(start)
    give_back()


def classes(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, n, m, cls, of): set size, those of even hash, set hash, row key."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches, 1):
            sets = shingle_sets(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([int((s & np.uint64(1) == 0).sum()) for s in sets], pa.int32()), pa.array([set_key(s) for s in sets], pa.int64()), b.column(2)], ["doc_id", "n", "m", "cls", "of"])

    return staged(docs.select("doc_id", "text", row_key(docs).alias("of")).mapInArrow(run, "doc_id long, n int, m int, cls long, of long"), "sets")


def _short(h: np.ndarray) -> bytes:
    """The low five bytes after the even bit; the column block comes from the high ones."""
    return np.ascontiguousarray((h >> np.uint64(1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def _column_block(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(44)) * np.uint64(blocks) >> np.uint64(20)).astype(np.int64)


def shared_counts(docs: DataFrame, blocks: int) -> DataFrame:
    """(cls, shared): of the class's even-hash shingles, those that another class has; rows of 0 are missing.
    A block of documents sends one message to each column block and gets one back; its counts are summed there."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for b in _chunks(batches, 0):
            seen: dict[int, np.ndarray] = {}
            for s in shingle_sets(b.column(0)):
                if len(s):
                    seen.setdefault(set_key(s), s[s & np.uint64(1) == 0])
            if not seen:
                continue
            keys = np.array(list(seen), np.int64)
            h, owner = np.concatenate(list(seen.values())), np.repeat(np.arange(len(keys)), [len(s) for s in seen.values()])
            order = np.argsort(h, kind="stable")
            h, owner = h[order], owner[order]
            first = np.r_[True, h[1:] != h[:-1]][: len(h)]
            here = np.diff(np.r_[np.flatnonzero(first), len(h)])  # classes of this block that have it
            many = np.repeat(here > 1, here)
            cb = _column_block(h, blocks)
            begins = np.flatnonzero(np.r_[True, cb[1:] != cb[:-1]][: len(cb)]).tolist()
            out = {"cb": [], "keys": [], "counts": [], "local": [], "hashes": [], "common": []}
            for lo, hi in zip(begins, [*begins[1:], len(cb)], strict=True):  # the column blocks that it has, however many there are
                k = int(cb[lo])
                hk, ok, mk = h[lo:hi], owner[lo:hi], many[lo:hi]
                local = np.bincount(ok[mk], minlength=len(keys))
                single = ok[~mk]
                by = np.argsort(single, kind="stable")
                counts = np.bincount(single, minlength=len(keys))
                on = np.flatnonzero(counts + local)
                out["cb"].append(k)
                out["keys"].append(keys[on].astype("<i8").tobytes())
                out["counts"].append(counts[on].astype("<u4").tobytes())
                out["local"].append(local[on].astype("<u4").tobytes())
                out["hashes"].append(_short(hk[~mk][by]))
                out["common"].append(_short(hk[mk & first[lo:hi]]))
            out["block"] = [block] * len(out["cb"])
            block += 1
            yield pa.RecordBatch.from_pydict({k: pa.array(v, {"cb": pa.int32(), "block": pa.int64()}.get(k, pa.binary())) for k, v in out.items()})

    def column(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]

    @tidy
    def join(table: pa.Table) -> pa.Table:
        each, counts, local = column(table, "keys", "<i8"), column(table, "counts", "<u4"), column(table, "local", "<u4")
        keys, n = np.concatenate(each), np.concatenate(counts)
        h = _long(b"".join(x.as_py() for x in table.column("hashes")))
        common = np.unique(_long(b"".join(x.as_py() for x in table.column("common"))))
        order = np.argsort(h, kind="stable")
        hs, ks = h[order], np.repeat(keys, n)[order]
        starts = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]]) if len(hs) else np.zeros(0, np.int64)
        shared = np.zeros(len(h), bool)
        if len(hs):
            two = np.minimum.reduceat(ks, starts) != np.maximum.reduceat(ks, starts)
            two |= np.isin(hs[starts], common, assume_unique=True)
            shared[order] = np.repeat(two, np.diff(np.r_[starts, len(hs)]))
        ends = np.r_[0, np.cumsum(shared)]
        at = np.r_[0, np.cumsum(n, dtype=np.int64)]
        total = np.concatenate(local) + (ends[at[1:]] - ends[at[:-1]])
        cuts, back = np.cumsum([0, *map(len, each)]), ([], [], [])
        for i, block in enumerate(table.column("block").to_pylist()):
            k, t = each[i], total[cuts[i]:cuts[i + 1]]
            if t.any():
                back[0].append(block)
                back[1].append(k[t > 0].tobytes())
                back[2].append(t[t > 0].astype("<u4").tobytes())
        return pa.table({"block": pa.array(back[0], pa.int64()), "keys": pa.array(back[1], pa.binary()), "n": pa.array(back[2], pa.binary())})

    @tidy
    def add(table: pa.Table) -> pa.Table:
        keys, at = np.unique(np.concatenate(column(table, "keys", "<i8")), return_inverse=True)
        return pa.table({"cls": keys, "shared": np.bincount(at, np.concatenate(column(table, "n", "<u4"))).astype(np.int64)})

    sent = docs.select("text").mapInArrow(send, "cb int, keys binary, counts binary, local binary, hashes binary, common binary, block long")
    back = sent.groupBy("cb").applyInArrow(join, "block long, keys binary, n binary")
    # copies of a class in other blocks have the same counts there
    return back.groupBy("block").applyInArrow(add, "cls long, shared long").groupBy("cls").agg(F.max("shared").alias("shared"))


def _first() -> Column:
    """Order of the rows that may stand for others: by doc_id, null ids last, then by key."""
    return F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.col("of").alias("of"))


def survivors(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Staged (cls, n, rep, rep_of, docs): classes that the bound on unshared shingles leaves, with
    set size, the doc_id and row key of a row to fetch each by, and its documents."""
    size = sets.filter("n > 0").agg(F.sum("m")).first()[0] or 0
    reps = sets.filter("n > 0").groupBy("cls").agg(F.min(_first()).alias("rep"), F.first("n").alias("n"), F.first("m").alias("m"), F.count("*").alias("docs"))
    shared = shared_counts(docs, max(1, -(-size // BLOCK_COLUMNS)))
    left = reps.alias("r").join(shared.alias("s"), F.col("r.cls") == F.col("s.cls"), "left")
    bound = F.col("m") - (F.col("n") - F.ceil(F.lit(NUM) * F.col("n") / DEN))
    return staged(left.filter(F.coalesce("shared", F.lit(0)) >= bound).select("r.cls", "r.n", F.col("r.rep.id").alias("rep"), F.col("r.rep.of").alias("rep_of"), "r.docs"), "survivors")


def fetch_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Staged blocks (block, keys, sizes, hashes) of the chosen classes' whole sets."""
    small = chosen.count() <= BROADCAST_ROWS
    rows = docs.select("doc_id", "text", row_key(docs).alias("of"))
    picked = rows.join(F.broadcast(chosen) if small else chosen, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("of") == F.col("rep_of")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        done: set[int] = set()
        for b in _chunks(batches, 1, BLOCK_CHARS // 4):
            sets = {}
            for s, want in zip(shingle_sets(b.column(1)), b.column(2).to_pylist(), strict=True):
                if want not in done and set_key(s) == want:
                    sets[want] = s
                    done.add(want)
            if sets:
                yield pa.RecordBatch.from_pydict({"block": [block], "keys": [np.array(list(sets), "<i8").tobytes()], "sizes": [np.array([len(s) for s in sets.values()], "<u4").tobytes()], "hashes": [np.concatenate(list(sets.values())).astype("<u8").tobytes()]})
                block += 1

    return staged(picked.select("doc_id", "text", "cls").mapInArrow(run, "block long, keys binary, sizes binary, hashes binary"), "kept-sets")


def _read_block(keys: bytes, sizes: bytes, hashes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(keys, "<i8"), np.frombuffer(sizes, "<u4").astype(np.int64), np.frombuffer(hashes, "<u8")


def prefixes(kept: DataFrame, blocks: int) -> DataFrame:
    """(hash, cls): each class's rarest floor(n/4) + 1 shingles, as far as another class has them.
    Frequencies are over the kept blocks; a class in two blocks counts twice, which changes the order alone."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                h, n = np.unique(_read_block(row["keys"], row["sizes"], row["hashes"])[2], return_counts=True)
                cb = _column_block(h, blocks)
                begins = np.flatnonzero(np.r_[True, cb[1:] != cb[:-1]][: len(cb)])
                spans = [slice(a, b) for a, b in zip(begins.tolist(), [*begins.tolist()[1:], len(cb)], strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "cb": pa.array(cb[begins], pa.int32()), "block": pa.array([row["block"]] * len(spans), pa.int64()),
                    "hashes": pa.array([h[x].astype("<u8").tobytes() for x in spans], pa.binary()), "n": pa.array([n[x].astype("<u4").tobytes() for x in spans], pa.binary())})

    @tidy
    def count(table: pa.Table) -> pa.Table:
        hs, ns = ([np.frombuffer(x, t) for x in table.column(c).to_pylist()] for c, t in (("hashes", "<u8"), ("n", "<u4")))
        uniq, at = np.unique(np.concatenate(hs), return_inverse=True)
        df = np.bincount(at, np.concatenate(ns)).astype(np.int64)[at]
        outs, start = {"block": [], "hashes": [], "df": []}, 0
        for block, h in zip(table.column("block").to_pylist(), hs, strict=True):
            d = df[start:start + len(h)]
            start += len(h)
            on = d > 1
            if on.any():
                outs["block"].append(block)
                outs["hashes"].append(h[on].tobytes())
                outs["df"].append(np.minimum(d[on], 2**32 - 1).astype("<u4").tobytes())
        return pa.table({"block": pa.array(outs["block"], pa.int64()), "hashes": pa.array(outs["hashes"], pa.binary()), "df": pa.array(outs["df"], pa.binary())})

    def choose(own: pa.Table, back: pa.Table) -> pa.Table:
        h = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(x, "<u8") for x in back.column("hashes").to_pylist())])
        df = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(x, "<u4") for x in back.column("df").to_pylist())])
        order = np.argsort(h)
        h, df = h[order], df[order]
        got_h, got_k = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in own.to_pylist() if len(h) else ():
            keys, sizes, hashes = _read_block(row["keys"], row["sizes"], row["hashes"])
            at = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
            shared = h[at] == hashes
            end = 0
            for key, n in zip(keys.tolist(), sizes.tolist(), strict=True):
                span = slice(end, end + n)
                end += n
                on = shared[span]
                take = slack(n) + 1 - (n - int(on.sum()))
                if take > 0:
                    x = hashes[span][on]
                    x = x[np.lexsort((x, df[at[span][on]]))[:take]]
                    got_h.append(x.view("<i8"))
                    got_k.append(np.full(len(x), key))
        return pa.table({"hash": np.concatenate(got_h), "cls": np.concatenate(got_k)})

    back = kept.mapInArrow(send, "cb int, block long, hashes binary, n binary").groupBy("cb").applyInArrow(count, "block long, hashes binary, df binary")
    return kept.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(choose, "hash long, cls long")


def _band(n: Column) -> Column:
    """Bands of set sizes, each 4/3 of the one below: linked sets are in one band or in two side by side."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(DEN / NUM)) + 1e-9).cast("int")


def _load(n: Column) -> Column:
    """Share of a product that a set of n takes, by rows or by shingles."""
    return F.greatest(F.lit(1 / TILE), n / TILE_SHINGLES)


class Tile:
    """Sparse incidence of a tile's rows, to be multiplied with other rows."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        rows = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(h, kind="stable")
        hs = h[order]
        self.starts = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]]) if len(hs) else np.zeros(0, np.int64)
        self.hashes, self.postings = hs[self.starts], rows[order]
        self.width = np.diff(np.r_[self.starts, len(hs)])
        wide = self.width * DENSE > max(len(sets), 4 * DENSE)
        self.place = np.where(wide, np.cumsum(wide) - 1, -1)
        at = np.repeat(self.place, self.width)
        self.dense = np.zeros((int(wide.sum()), len(sets)), bool)
        self.dense[at[at >= 0], self.postings[at >= 0]] = True

    def _over(self, sets: list[np.ndarray]) -> np.ndarray:
        """Shingles that each of the sets has in common with each row."""
        n, h = len(self.sizes), np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        on = self.hashes[at] == h
        col, owner = at[on], owner[on]
        wide = self.place[col] >= 0
        thin, width = col[~wide], self.width[col[~wide]]
        flat = np.repeat(self.starts[thin] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        over = np.bincount(np.repeat(owner[~wide], width) * n + self.postings[flat], minlength=len(sets) * n).reshape(len(sets), n)
        place, owner = self.place[col[wide]], owner[wide]
        for lo in range(0, len(self.dense), 1024):
            some = (place >= lo) & (place < lo + 1024)
            left = np.zeros((len(sets), min(1024, len(self.dense) - lo)), np.float32)
            left[owner[some], place[some] - lo] = 1
            over += (left @ self.dense[lo:lo + 1024].astype(np.float32)).astype(np.int64)
        return over

    def linked(self, sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """Runs of the sets, by their first, with a matrix of which rows each is alike enough to."""
        size = np.array([len(s) for s in sets], np.int64)
        # a set's cells: the rows, and the postings of its thin columns
        thin = size * (len(self.sizes) // DENSE + 4)
        run = np.cumsum(len(self.sizes) + np.minimum(thin, len(self.postings))) // CELLS
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sets)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b and len(self.sizes):
                over, n = self._over(sets[a:b]), size[a:b, None]
                yield a, DEN * over >= NUM * (self.sizes + n - over)


def multiply(left: list[np.ndarray], right: list[np.ndarray] | None, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows of left, then those of right: component label (a row number, the
    least) and documents linked to, where docs is each row's documents. All pairs of
    left and right are decided, or of left and left if right is None."""
    other, base = (left, 0) if right is None else (right, len(left))
    labels, found = np.arange(len(docs)), np.zeros(len(docs), np.int64)
    theirs = docs[base:base + len(other)]
    for first, near in Tile(other).linked(left):
        if right is None:
            near[np.arange(len(near)), first + np.arange(len(near))] = False
        else:
            found[base:] += docs[first:first + len(near)] @ near
        found[first:first + len(near)] += near @ theirs
        for i in np.flatnonzero(near.any(1)):
            roots = np.unique(np.r_[labels[first + i], labels[base + np.flatnonzero(near[i])]])
            if len(roots) > 1:
                labels[np.isin(labels, roots)] = roots[0]
    return labels, found


def links(kept: DataFrame, tokens: DataFrame, chosen: DataFrame) -> DataFrame:
    """Staged (u, v, n), one row a class and product: its least class in the component
    there and the documents of the classes that it links to. The pairs (u, v) connect all
    linked classes; the sums of n over u are exact, as every pair of classes is in one product."""
    lead = tokens.groupBy("hash").agg(F.min("cls").alias("lead"), F.count("*").alias("k")).filter("k > 1")
    stars = tokens.alias("t").join(lead.alias("l"), F.col("t.hash") == F.col("l.hash")).filter("t.cls <> l.lead").select(F.col("t.cls").alias("u"), F.col("l.lead").alias("v")).distinct()
    groups = components(stars)
    member = groups.union(groups.select(F.col("label").alias("u"), "label").distinct())
    member = member.alias("m").join(chosen.alias("c"), F.col("m.u") == F.col("c.cls")).select("c.cls", "c.docs", F.col("m.label").alias("grp"), _band(F.col("c.n")).alias("band"), _load(F.col("c.n")).alias("load"))
    # k: how many products' worth of rows or shingles, whichever there is more of
    bands = staged(member.groupBy("grp", "band").agg(F.sum("load").alias("k")), "bands")
    whole = bands.groupBy("grp").agg(F.sum("k").alias("all"))
    total = whole.filter(F.col("all") <= 1).agg(F.sum("all")).first()[0] or 0
    bins = max(1, math.ceil(total / BIN))
    # of a large group, the tiles of each band; two tiles fill a product
    tiles = bands.withColumn("t", F.ceil(F.col("k") * 2).cast("long")).alias("b")
    beside = lambda d, x: bands.select(F.col("grp").alias(f"g_{x}"), (F.col("band") - d).alias(f"b_{x}"), F.ceil(F.col("k") * 2).cast("long").alias(f"t_{x}"))
    at = lambda x: (F.col("b.grp") == F.col(f"g_{x}")) & (F.col("b.band") == F.col(f"b_{x}"))
    tiles = tiles.join(whole.alias("w"), F.col("b.grp") == F.col("w.grp")).join(beside(1, "up"), at("up"), "left").join(beside(-1, "down"), at("down"), "left")
    tiles = tiles.select("b.grp", "b.band", (F.col("all") > 1).alias("large"), "t", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("t_up", "t_down")])
    placed = member.alias("m").join(tiles.alias("s"), (F.col("m.grp") == F.col("s.grp")) & (F.col("m.band") == F.col("s.band"))).select("m.*", "large", "t", "t_up", "t_down")
    zero = F.lit(0).cast("long")
    own = F.pmod(F.xxhash64("cls"), F.col("t"))
    # each tile meets itself, the others of its band and those of the bands beside it: (band of the left tile, tile, band of the right one, tile)
    all_of = lambda n: F.filter(F.sequence(zero, F.greatest(n, zero)), lambda i: i < n)
    meet = F.concat(
        F.transform(all_of(F.col("t")), lambda i: F.struct(F.col("band").alias("bi"), F.least(own, i).alias("i"), F.col("band").alias("bj"), F.greatest(own, i).alias("j"))),
        F.transform(all_of(F.col("t_up")), lambda i: F.struct(F.col("band").alias("bi"), own.alias("i"), (F.col("band") + 1).alias("bj"), i.alias("j"))),
        F.transform(all_of(F.col("t_down")), lambda i: F.struct((F.col("band") - 1).alias("bi"), i.alias("i"), F.col("band").alias("bj"), own.alias("j"))))
    small = F.array(F.struct(zero.cast("int").alias("bi"), F.pmod(F.xxhash64("grp"), F.lit(bins).cast("long")).alias("i"), zero.cast("int").alias("bj"), F.pmod(F.xxhash64("grp"), F.lit(bins).cast("long")).alias("j")))
    placed = placed.select("cls", "docs", F.when(F.col("large"), F.col("grp")).otherwise(zero).alias("unit"), F.when(F.col("large"), F.col("band")).otherwise(0).alias("band"), F.when(F.col("large"), own).otherwise(F.pmod(F.xxhash64("grp"), F.lit(bins).cast("long"))).alias("tile"), F.when(F.col("large"), meet).otherwise(small).alias("with_"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                keys, sizes_, hashes = _read_block(row["keys"], row["sizes"], row["hashes"])
                at = np.r_[0, np.cumsum(sizes_)]
                yield pa.RecordBatch.from_pydict({"cls": pa.array(keys), "set": pa.array([hashes[at[i]:at[i + 1]].tobytes() for i in range(len(keys))], pa.binary())})

    sets = kept.mapInArrow(rows, "cls long, set binary")
    full = sets.alias("a").join(placed.alias("p"), F.col("a.cls") == F.col("p.cls")).select("a.cls", "set", "docs", "unit", "band", "tile", F.explode("with_").alias("w"))
    work = full.select("cls", "set", "docs", "unit", ((F.col("band") == F.col("w.bi")) & (F.col("tile") == F.col("w.i"))).alias("left"), ((F.col("w.bi") == F.col("w.bj")) & (F.col("w.i") == F.col("w.j"))).alias("same"), "w.bi", "w.i", "w.bj", "w.j")

    @tidy
    def product(table: pa.Table) -> pa.Table:
        raw = [table.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "docs", "left", "same")]
        order = np.lexsort((raw[0], ~raw[2]))  # the left tile's rows come first
        keys, docs, left, same = (x[order] for x in raw)
        one = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])  # a class may come from two blocks
        keys, docs, left, order = keys[one], docs[one], left[one], order[one]
        column = table.column("set")
        own = [np.frombuffer(column[int(k)].as_buffer(), "<u8") for k in order]
        half = len(own) if same[0] else int(left.sum())
        labels, found = multiply(own[:half], None if same[0] else own[half:], docs)
        return pa.table({"u": keys, "v": keys[labels], "n": found})

    return staged(work.groupBy("unit", "bi", "i", "bj", "j").applyInArrow(product, "u long, v long, n long"), "links")


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """classes(docs), and staged (cls, label, docs, n): of each class with shingles its
    component's label, its documents and those of the classes it links to."""
    ship(docs.sparkSession)
    sets = classes(docs)
    chosen = survivors(docs, sets)
    kept = fetch_sets(docs, chosen)
    total = (sets.filter("n > 0").agg(F.sum("n")).first()[0] or 0)
    tokens = staged(prefixes(kept, max(1, -(-total // BLOCK_COLUMNS))), "prefixes")
    found = links(kept, tokens, chosen)
    roots = components(found.select("u", "v"))
    sums = found.groupBy("u").agg(F.sum("n").alias("n"))
    named = sets.filter("n > 0").groupBy("cls").agg(F.count("*").alias("docs"), F.min(_first()).alias("least"))
    named = named.alias("a").join(roots.alias("r"), F.col("a.cls") == F.col("r.u"), "left").join(sums.alias("s"), F.col("a.cls") == F.col("s.u"), "left")
    return sets, staged(named.select("a.cls", "a.docs", "a.least", F.coalesce("r.label", "a.cls").alias("label"), F.coalesce("s.n", F.lit(0)).alias("n")), "named")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) to one row per row: doc_id, n_shingles, component_id, n_links."""
    sets, named = linked(docs.select("doc_id", "text"))
    least = named.groupBy("label").agg(F.min("least.id").alias("component"))
    ids = named.alias("a").join(least.alias("b"), F.col("a.label") == F.col("b.label")).select("a.cls", "b.component", (F.col("a.docs") - 1 + F.col("a.n")).alias("n_links"))
    out = sets.alias("s").join(ids.alias("i"), (F.col("s.cls") == F.col("i.cls")) & (F.col("s.n") > 0), "left")
    return out.select("s.doc_id", F.col("s.n").cast("long").alias("n_shingles"), F.when(F.col("s.n") > 0, F.col("i.component")).otherwise(F.col("s.doc_id")).alias("component_id"), F.coalesce("i.n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, columns as they are: the one of smallest
    doc_id (null ids last), then of smallest row key. Rows are told apart by doc_id and
    key, so equal or null ids tie no texts together. Texts without shingles all stay."""
    sets, named = linked(docs)
    pick = named.groupBy("label").agg(F.min("least").alias("p")).select(F.col("p.id").alias("_id"), F.col("p.of").alias("_of"), F.lit(True).alias("_one"))
    blank = sets.filter("n = 0").select("doc_id", "of", F.lit(False)).distinct()
    stay = staged(pick.union(blank), "stay")
    small = stay.count() <= BROADCAST_ROWS
    key, no, of, one = free(docs, "_key", "_id", "_of", "_one")
    keyed = docs.withColumn(key, row_key(docs))
    same = F.col("doc_id").eqNullSafe(F.col(no)) & (F.col(key) == F.col(of))
    out = keyed.join((F.broadcast(stay) if small else stay).toDF(no, of, one), same).drop(no, of, one)
    # rows that equal the picked one in every column: one of them stays
    picked = sets.filter("n > 0").alias("a").join(stay.filter("_one").alias("s"), F.col("a.doc_id").eqNullSafe(F.col("s._id")) & (F.col("a.of") == F.col("s._of")))
    more = staged(picked.groupBy("a.doc_id", "a.of").agg(F.count("*").alias("k")).filter("k > 1").select("doc_id", "of"), "repeated").toDF(no, of)
    if more.limit(1).count() == 0:
        return out.drop(key)
    return out.join(more, same, "left_anti").union(out.join(more, same, "left_semi").dropDuplicates(["doc_id", key])).drop(key)
