"""Fill-in-middle transformation by a parallel automaton scan.

A unit (a line, a word) is recognised by a small automaton over bytes that counts where
units begin. A stretch of text is a function from the state it is entered in to the state
it is left in and the units that begin inside; such functions compose associatively. So
all stretches are scanned at once from every start state, a prefix composition resolves
the state each is entered in, and the place where unit k begins is found by a search in
the counts and a second look at the one stretch that holds it.

This happens at two levels. In a task, all texts of a batch are cut into stretches of
PIECE bytes that numpy scans in lockstep. A text of more than CHUNK code points is dealt
out over tasks in chunks; each gives its function, the functions of a text (32,768 at
most, as a cell holds 2 GB) are composed, the search names the chunks that hold the two
cuts, and those alone are looked at again. Chunks are dealt by row and place, so many
copies of one long text spread as well. Functions are kept by the text's sha256.

Edge cases: a null text counts as empty; it has no units and stays plain. So does a text
that contains one of the markers. A null doc_id draws as the string 'null' does; rows of
equal doc_id and text are cut alike. Cuts may coincide, also with the text's ends, so
any part may be empty. Other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coded import flat_bytes, slices
from .env import free, ship, staged

PIECE = 256  # bytes scanned in one lockstep lane
CHUNK = 1 << 16  # code points that one task scans of a longer text
MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
SEED, RATE, SPM = 7, 100, 50  # percent of texts that are transformed, and of those in suffix-first form


class Automaton:
    """step[state][class] is the next state, begins[state][class] whether a unit begins with that byte; state 0 is the start."""

    def __init__(self, classes: np.ndarray, step: list[list[int]], begins: list[list[int]]) -> None:
        self.size, own = len(step), list(range(len(step)))
        self.pad = len(step[0])  # a class of its own that changes nothing, for the ends of short stretches
        self.classes = classes.astype(np.uint8)
        self.step = np.array([*zip(*step, strict=True), own], np.uint8).ravel()  # by class, then state
        self.begins = np.array([*zip(*begins, strict=True), [0] * len(own)], np.int32).ravel()

    def lanes(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Classes of stretches of data, one column each."""
        steps = np.arange(PIECE)
        at = start[None, :] + steps[:, None]
        np.minimum(at, max(len(data) - 1, 0), out=at)
        found = self.classes[data[at]] if len(data) else np.zeros(at.shape, np.uint8)
        found[steps[:, None] >= length[None, :]] = self.pad
        return found

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> Scan:
        """The function of every stretch of texts that stand end to end in data."""
        size = np.diff(offsets)
        pieces = np.maximum(1, -(-size // PIECE))
        first = np.cumsum(pieces) - pieces
        owner = np.repeat(np.arange(len(size)), pieces)
        place = np.arange(len(owner)) - first[owner]
        start = offsets[owner] + place * PIECE
        length = np.minimum(PIECE, offsets[owner + 1] - start)
        state = np.repeat(np.arange(self.size, dtype=np.uint8)[:, None], len(owner), 1)
        count = np.zeros(state.shape, np.int32)
        for column in self.lanes(data, start, length):
            code = state + column * np.uint8(self.size)
            count += self.begins[code]
            state = self.step[code]
        return Scan(self, data, offsets, first, pieces, start, length, state, count.astype(np.int64), place)


def compose(state: np.ndarray, count: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix composition of functions (a row for each start state, a column for each
    stretch); place is a stretch's number in its text. By doubling: each round, a
    stretch's function takes in that of the run of equally many stretches before it."""
    reach, top = 1, int(place.max(initial=0))
    while reach <= top:
        late = np.flatnonzero(place >= reach)
        via, before = state[:, late - reach], count[:, late - reach]
        state, count = state.copy(), count.copy()
        count[:, late], state[:, late] = before + np.take_along_axis(count[:, late], via, 0), np.take_along_axis(state[:, late], via, 0)
        reach *= 2
    return state, count


def _shifted(through: np.ndarray, place: np.ndarray, none: np.ndarray) -> np.ndarray:
    """What holds before each stretch, from what holds through it."""
    before = np.roll(through, 1, 1)
    before[:, place == 0] = none[:, None]
    return before


class Scan:
    def __init__(self, own: Automaton, data, offsets, first, pieces, start, length, state, count, place) -> None:
        self.own, self.data, self.offsets, self.start, self.length, self.first = own, data, offsets, start, length, first
        through_state, through_count = compose(state, count, place)
        last = first + pieces - 1
        self.end, self.total = through_state[:, last], through_count[:, last]  # of each text, by its start state
        self.entry = _shifted(through_state, place, np.arange(own.size, dtype=np.uint8))
        self.before = _shifted(through_count, place, np.zeros(own.size, np.int64))
        self.owner = np.repeat(np.arange(len(first)), pieces)

    def select(self, state: np.ndarray, k: np.ndarray) -> np.ndarray:
        """For each text, entered in its state, the place in data where its unit k (from 0) begins; its end if it has no such unit."""
        every = np.arange(len(self.first))
        before = self.before[state[self.owner], np.arange(len(self.owner))]
        # counts never fall within a text, so (text, count) stands in order
        piece = np.searchsorted(self.owner * (1 << 32) + before, every * (1 << 32) + k, "right") - 1
        piece = np.maximum(piece, self.first)
        now, left = self.entry[state, piece], k - before[piece]
        out = np.where(k < self.total[state, every], -1, self.offsets[1:])
        for i, column in enumerate(self.own.lanes(self.data, self.start[piece], self.length[piece])):
            code = now + column * np.uint8(self.own.size)
            begins = self.own.begins[code]
            out[(out < 0) & (begins > 0) & (left == 0)] = -2 - i
            left = left - begins
            now = self.own.step[code]
        return np.where(out < -1, self.start[piece] - 2 - out, out)


def _line_classes() -> np.ndarray:
    return np.arange(256) == 0x0A


def _word_classes() -> np.ndarray:
    return np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


#: Units by name. A line ends with its line break; a word takes the white space after it, and the first word that before it.
UNITS = {
    "line": Automaton(_line_classes(), [[1, 0], [1, 0]], [[1, 1], [0, 0]]),
    "word": Automaton(_word_classes(), [[1, 0], [1, 0]], [[1, 0], [0, 0]]),
}


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte of UTF-8, and in all."""
    return np.r_[0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)]


def _cuts(unit: str):
    """For whole texts: units and the code points before either cut."""

    def run(texts: pa.Array, draw1: pa.Array, draw2: pa.Array) -> pa.Array:
        own, at, found = UNITS[unit], 0, []
        draws = [d.to_numpy(zero_copy_only=False).astype(np.int64) for d in (draw1, draw2)]
        for some in slices(texts):
            data, offsets = flat_bytes(some)
            scan = own.scan(data, offsets)
            start, n, before = np.zeros(len(some), np.int64), scan.total[0], code_points(data)
            ranks = np.sort([d[at:at + len(some)] % (n + 1) for d in draws], 0)
            cuts = [before[np.where(k == 0, offsets[:-1], scan.select(start, k))] - before[offsets[:-1]] for k in ranks]
            found.append((n, *cuts))
            at += len(some)
        parts = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3)]
        return pa.StructArray.from_arrays([pa.array(p, pa.int64()) for p in parts], ["n", "c1", "c2"])

    return F.arrow_udf(run, "struct<n:long,c1:long,c2:long>")


def _functions(unit: str):
    """For chunks of texts: end state and units begun, by start state."""

    def run(chunks: pa.Array) -> pa.Array:
        scans = [UNITS[unit].scan(*flat_bytes(some)) for some in slices(chunks)]
        lists = lambda parts, kind: pa.ListArray.from_arrays(pa.array(np.arange(sum(p.shape[1] for p in parts) + 1) * UNITS[unit].size, pa.int32()), pa.array(np.concatenate([p.T.ravel() for p in parts]) if parts else [], kind))
        return pa.StructArray.from_arrays([lists([s.end for s in scans], pa.int32()), lists([s.total for s in scans], pa.int64())], ["ends", "counts"])

    return F.arrow_udf(run, "struct<ends:array<int>,counts:array<long>>")


def _entries(unit: str):
    """For the functions of a text's chunks in order: units, and the state and the units before each chunk."""

    def run(lists: pa.Array) -> pa.Array:
        size, chunks = UNITS[unit].size, lists.flatten()
        by_state = lambda name, kind: pc.list_flatten(pc.struct_field(pc.struct_field(chunks, "f"), name)).to_numpy(zero_copy_only=False).astype(kind).reshape(-1, size).T
        pieces = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(pieces) - pieces
        place = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
        state, count = compose(by_state("ends", np.uint8), by_state("counts", np.int64), place)
        offsets = pa.array(np.r_[first, pieces.sum()], pa.int32())
        entry = _shifted(state, place, np.arange(size, dtype=np.uint8))[0].astype(np.int32)
        before = _shifted(count, place, np.zeros(size, np.int64))[0]
        return pa.StructArray.from_arrays([pa.array(count[0, first + pieces - 1], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(entry)), pa.ListArray.from_arrays(offsets, pa.array(before))], ["n", "entry", "before"])

    return F.arrow_udf(run, "struct<n:long,entry:array<int>,before:array<long>>")


def _select(unit: str):
    """Code points of a chunk before its unit k begins, the chunk entered in a state."""

    def run(chunks: pa.Array, state: pa.Array, k: pa.Array) -> pa.Array:
        at, found = 0, [np.zeros(0, np.int64)]
        state, k = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (state, k))
        for some in slices(chunks):
            data, offsets = flat_bytes(some)
            before = code_points(data)
            found.append(before[UNITS[unit].scan(data, offsets).select(state[at:at + len(some)], k[at:at + len(some)])] - before[offsets[:-1]])
            at += len(some)
        return pa.array(np.concatenate(found), pa.int64())

    return F.arrow_udf(run, "long")


def chunk_functions(texts: DataFrame, unit: str, chunk: int = CHUNK) -> DataFrame:
    """texts (digest, text) to (digest, place, f): the function of each chunk, scanned by tasks of its own."""
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    rows = texts.withColumn("at", F.monotonically_increasing_id()).select("digest", "at", F.posexplode(pieces).alias("place", "piece"))
    return rows.repartition("at", "place").select("digest", "place", _functions(unit)("piece").alias("f")).distinct()


def _long_cuts(docs: DataFrame, text: Column, draws: list[Column], unit: str, chunk: int, cut: str) -> DataFrame:
    """docs of long texts with the column cut, as _cuts gives it."""
    digest, long, n, k1, k2, at = free(docs, "_digest", "_scan", "_n", "_k1", "_k2", "_at")
    functions = chunk_functions(docs.select(F.sha2(text, 256).alias("digest"), text.alias("text")), unit, chunk)
    scans = functions.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("place", "f"))).alias("fs")).select(F.col("digest").alias(digest), _entries(unit)("fs").alias(long))
    # read from files, so Spark broadcasts them only if they are small
    both = docs.withColumn(digest, F.sha2(text, 256)).join(staged(scans, "fim-scans"), digest).withColumn(n, F.col(f"{long}.n"))
    ranks = [d % (F.col(n) + 1) for d in draws]
    both = both.withColumns({k1: F.least(*ranks), k2: F.greatest(*ranks)})
    for k in (k1, k2):
        place = F.size(F.filter(f"{long}.before", lambda b: b <= F.col(k))) - 1  # noqa: B023
        both = both.withColumn(at, place)
        of = lambda name: F.get(f"{long}.{name}", F.col(at))
        inside = _select(unit)(F.substring(text, F.col(at) * chunk + 1, F.lit(chunk)), of("entry"), F.col(k) - of("before"))
        both = both.withColumn(k + "_", F.when(F.col(k) == 0, F.lit(0)).otherwise(inside + F.col(at) * chunk))
    cuts = F.struct(F.col(n).alias("n"), F.col(k1 + "_").cast("long").alias("c1"), F.col(k2 + "_").cast("long").alias("c2"))
    return both.withColumn(cut, cuts).drop(digest, long, n, k1, k2, at, k1 + "_", k2 + "_")


def draw(i: int, seed: int = SEED, doc_id: str = "doc_id") -> Column:
    """Number i (from 0) of a document's draws from 0 to 2^32 - 1."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.sha2(key, 256), 8 * i + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, unit: str = "line", rate: int = RATE, spm: int = SPM, seed: int = SEED, markers: tuple[str, str, str] = MARKERS, text: str = "text", out: str = "fim", chunk: int = CHUNK) -> DataFrame:
    """Adds out: struct of n (units), form (plain, psm or spm), prefix_chars and
    middle_chars (code points; null if plain) and output."""
    ship(docs.sparkSession)
    whole, cut = F.coalesce(F.col(f"`{text}`"), F.lit("")), free(docs, "_cut")[0]
    draws = [draw(0, seed), draw(1, seed)]
    small, large = docs.filter(F.length(whole) <= chunk), docs.filter(F.length(whole) > chunk)
    both = small.withColumn(cut, _cuts(unit)(whole, *draws)).unionByName(_long_cuts(large, whole, draws, unit, chunk, cut))
    c1, c2 = F.col(f"{cut}.c1").cast("int"), F.col(f"{cut}.c2").cast("int")
    prefix, middle, suffix = F.substring(whole, F.lit(1), c1), F.substring(whole, c1 + 1, c2 - c1), F.substring(whole, c2 + 1, F.lit(2**31 - 1))
    p, s, m = map(F.lit, markers)
    plain = (whole == "") | F.contains(whole, p) | F.contains(whole, s) | F.contains(whole, m) | (draw(2, seed) % 100 >= rate)
    form = F.when(plain, "plain").when(draw(3, seed) % 100 < spm, "spm").otherwise("psm")
    output = F.when(form == "plain", whole).when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    chars = lambda c, name: F.when(form != "plain", c.cast("long")).alias(name)
    return both.withColumn(out, F.struct(F.col(f"{cut}.n").alias("n"), form.alias("form"), chars(c1, "prefix_chars"), chars(c2 - c1, "middle_chars"), output.alias("output"))).drop(cut)


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output of transform was made of. Such a text contains no marker, so
    the three in it are the only ones."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(1), part(3), part(2))).otherwise(F.concat(part(2), part(3), part(1)))
