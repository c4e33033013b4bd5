"""Token files: one wavelet matrix per shard of whole documents in ascending doc_id.

A shard's file image holds the document index and, per bit of the token ids from the
highest down, a bit plane of all its tokens, in the order that the earlier planes'
stable partition (zeros first) left them, with a directory of ones before every 512
bits. Both are compressed in frames of 8 KB, and a reader unpacks only those it meets:
access(i), rank(token, i) and count(token) take a frame or two of each plane and directory,
select(token, k) also the whole directory; tokens() restores the whole sequence. Images are
rows of a Parquet table in the shared folder, so writing is atomic and a lost executor's
part is written again; export() puts them out as plain files, read_file() opens one.

A shard ends with the document that brings it to SHARD_TOKENS, so one very long
document makes one larger shard.

Edge cases: null or empty text is the end token alone. Null ids come first; rows of equal
or null id stand by a hash of the text and then by the text, and may fill many parts. An empty table gives no shard.
"""

from __future__ import annotations

import gc
import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_chars, vocab_path
from .coded import Recent, distinct, lay, per_text, raw_bytes, slices, split_words, spread
from .env import parallelism, ship, staged

VOCAB = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 1 << 20
BLOCK = 512  # bits between directory entries
FRAME = 1 << 13  # bytes that are compressed together
CACHE_WORDS = 250_000  # in each of two generations
MAGIC = b"CWMX0002"


class WaveletMatrix:
    """Bit planes with rank and select over a sequence of ids."""

    def __init__(self, n: int, bits: int, planes: list, zeros: list[int], ones: list) -> None:
        """planes and ones (of 4-byte numbers): bytes, as arrays or Frames."""
        self.n, self.bits, self.planes, self.zeros, self.ones = n, bits, planes, zeros, ones

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, ones = [], [], []
        for level in range(bits):
            bit = (now & (1 << (bits - 1 - level))) != 0
            packed = np.packbits(bit)
            planes.append(packed)
            counts = np.bitwise_count(np.pad(packed, (0, -len(packed) % (BLOCK // 8))).reshape(-1, BLOCK // 8)).sum(1, dtype=np.uint32)
            ones.append(np.concatenate(([0], np.cumsum(counts, dtype=np.uint32))).astype(np.uint32))
            low = now[~bit]
            zeros.append(len(low))
            now = np.concatenate((low, now[bit]))
        return cls(len(ids), bits, planes, zeros, [o.astype("<u4").view(np.uint8) for o in ones])

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits."""
        b = i // BLOCK
        part = self.planes[level][b * BLOCK // 8:(i + 7) // 8]
        if i % 8 and len(part):
            part = part.copy()
            part[-1] &= 0xFF << (8 - i % 8) & 0xFF
        return int(self.ones[level][4 * b:4 * b + 4].view("<u4")[0]) + int(np.bitwise_count(part).sum())

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            out = out << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the last level's order holds the token's occurrences among the first i ids."""
        lo, hi = 0, i
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences among the first i ids."""
        lo, hi = self._range(token, min(max(i, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of occurrence k, from 0."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in reversed(range(self.bits)):
            one = token >> (self.bits - 1 - level) & 1
            at = self._find(level, at - self.zeros[level], True) if one else self._find(level, at, False)
        return at

    def _find(self, level: int, k: int, one: bool) -> int:
        """Place of bit number k of its kind, by the directory, then inside the block."""
        before = self.ones[level][:].view("<u4").astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        b = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][b * BLOCK // 8:(b + 1) * BLOCK // 8])
        return b * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[b])])

    def tokens(self) -> np.ndarray:
        """All ids in order, from the last plane up."""
        out = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            bit = np.unpackbits(self.planes[level][:], count=self.n).view(bool)
            up = np.empty_like(out)
            z = self.zeros[level]
            up[~bit] = out[:z]
            up[bit] = out[z:] | (1 << (self.bits - 1 - level))
            out = up
        return out


class Frames:
    """Bytes that stand in an image as compressed frames of FRAME; a slice unpacks those that it meets, once."""

    def __init__(self, image: bytes, starts: list[int], n: int) -> None:
        self.image, self.starts, self.n, self.seen = image, starts, n, {}

    def _frame(self, k: int) -> bytes:
        import zstandard

        if k not in self.seen:
            self.seen[k] = zstandard.ZstdDecompressor().decompress(self.image[self.starts[k]:self.starts[k + 1]])
        return self.seen[k]

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, key: int | slice) -> np.ndarray | int:
        if not isinstance(key, slice):
            return self._frame(key // FRAME)[key % FRAME]
        lo, hi, _ = key.indices(self.n)
        raw = b"".join(self._frame(k) for k in range(lo // FRAME, -(-hi // FRAME))) if lo < hi else b""
        return np.frombuffer(raw, np.uint8)[lo % FRAME:lo % FRAME + hi - lo] if raw else np.zeros(0, np.uint8)


def write_image(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    wm = WaveletMatrix.build(ids, bits)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.packbits(known).tobytes(), np.array(lengths, "<i8").tobytes()]
    parts += [x for p, o in zip(wm.planes, wm.ones, strict=True) for x in (p.tobytes(), o.tobytes())]
    packed = [[pack(p[k:k + FRAME]) for k in range(0, len(p), FRAME)] for p in parts]
    sizes = [len(p) for p in parts] + [len(f) for fs in packed for f in fs]
    head = struct.pack("<8sIIQ", MAGIC, bits, len(doc_ids), wm.n) + struct.pack(f"<{bits}Q", *wm.zeros) + np.array(sizes, "<u8").tobytes()
    return head + b"".join(f for fs in packed for f in fs)


def read_image(image: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their token counts, and the wavelet matrix; planes stay packed until they are asked for."""
    magic, bits, n_docs, n = struct.unpack_from("<8sIIQ", image)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize("<8sIIQ")
    zeros = list(struct.unpack_from(f"<{bits}Q", image, at))
    at += 8 * bits
    raw = np.frombuffer(image, "<u8", 3 + 2 * bits, at).tolist()
    at += 8 * len(raw)
    counts = [-(-r // FRAME) for r in raw]
    sizes = np.frombuffer(image, "<u8", sum(counts), at)
    at += 8 * len(sizes)
    starts = (np.r_[0, np.cumsum(sizes, dtype=np.int64)] + at).tolist()
    cut = np.r_[0, np.cumsum(counts)].tolist()
    parts = [Frames(image, starts[a:b + 1], r) for a, b, r in zip(cut, cut[1:], raw, strict=False)]
    known = np.unpackbits(parts[1][:], count=n_docs).astype(bool)
    doc_ids = [int(d) if k else None for d, k in zip(parts[0][:].view("<i8"), known, strict=True)]
    return doc_ids, parts[2][:].view("<i8"), WaveletMatrix(n, bits, parts[3::2], zeros, parts[4::2])


#: ASCII marks other than the apostrophe: one piece of the pre-tokenizer, however many stand together.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Latin letters that are their own normal form.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch


class WordEncoder:
    """The tokenizers library over whole texts. Its pre-tokenizer never joins across
    ASCII white space, so a text's ids are those of the runs between such in order. Runs of
    Latin letters and marks go to the library's model by piece, letters in lower case, many
    distinct ones at once; all others through its whole pipeline. A worker keeps recent ones."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.chars = dict(enumerate(byte_chars()))
        # the library's model behind a pre-tokenizer that cuts at spaces alone, for many pieces at once
        self.lean = Tokenizer(self.tok.model)
        self.lean.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        own = self.tok.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(own.values()) + 1, bool)  # tokens that end a piece
        self.ends[[i for t, i in own.items() if t.endswith(self.tok.model.end_of_word_suffix or "\0")]] = True
        self.known, self.pieces = Recent(CACHE_WORDS), Recent(CACHE_WORDS)

    def _tokenize(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces (UTF-8, no spaces) as little-endian bytes. A piece's last token has the end-of-word suffix."""
        runs = (b" ".join(pieces[k:k + 1000]) for k in range(0, len(pieces), 1000))
        texts = [r.decode("ascii") if r.isascii() else r.decode("latin-1").translate(self.chars | {32: " "}) for r in runs]
        flat = np.array([i for e in self.lean.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], "<u4")
        ends = np.flatnonzero(self.ends[flat]) + 1
        if len(ends) != len(pieces):
            raise ValueError("the vocabulary has no end-of-word tokens")
        raw, cuts = flat.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        new = [p for p in self.pieces.missing(pieces) if p]
        now = self.pieces.now
        now.update(zip(new, self._tokenize(new), strict=True))
        return [now[p] if p else b"" for p in pieces]

    def _odd(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are not ASCII letters and marks."""
        known, plain = self.known.now, []
        for w in self.known.missing(words):
            core = w.rstrip(_MARKS)
            latin = None if core.isascii() else _LATIN(core.decode("utf-8", "surrogatepass"))
            letters = latin[0].lower() if latin else ""
            if letters.isalpha():  # one capital has no lower letter of its own
                plain.append((w, letters.encode(), w[len(core):]))
            else:
                known[w] = array("I", self.tok.encode(w.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids).tobytes()
        for w, letters, marks in zip((w for w, _, _ in plain), self._ids_of([p for _, p, _ in plain]), self._ids_of([m for _, _, m in plain]), strict=True):
            known[w] = letters + marks
        return [known[w] for w in words]

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        gc.disable()  # the caches are large to walk, and nothing here makes cycles
        try:
            words, offsets = split_words(texts)
            coded = words.dictionary_encode()
            own = coded.dictionary
            core = pc.ascii_rtrim(own, characters=_MARKS.decode())
            plain = pc.ascii_is_alpha(core)
            on = plain.to_numpy(zero_copy_only=False)
            # of each distinct word two parts: letters and marks, or the whole word and nothing
            letter_codes, letters = distinct(pc.ascii_lower(core.filter(plain)))
            mark_codes, marks = distinct(pc.ascii_ltrim(own.filter(plain), characters=string.ascii_letters))
            rest = raw_bytes(own.filter(pc.invert(plain)))
            table = [b"", *self._ids_of(letters), *self._ids_of(marks), *self._odd(rest)]
            parts = np.zeros((len(own), 2), np.int64)
            parts[on, 0], parts[on, 1] = 1 + letter_codes, 1 + len(letters) + mark_codes
            parts[~on, 0] = 1 + len(letters) + len(marks) + np.arange(len(rest))
            flat, each = spread(parts.ravel(), table, "<u4")
            flat, each = lay(coded.indices.to_numpy(zero_copy_only=False), flat, each.reshape(-1, 2).sum(1))
            self.known.trim()
            self.pieces.trim()
            return flat, per_text(each, offsets)
        finally:
            gc.enable()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        flat, n = self.encode_slice(pa.array([t or "" for t in texts], pa.string()))
        return np.split(flat, np.cumsum(n)[:-1]) if len(n) else []


_encoders: dict[str, WordEncoder] = {}


def encoder(vocab: str) -> WordEncoder:
    if vocab not in _encoders:
        _encoders[vocab] = WordEncoder(vocab_path(vocab))
    return _encoders[vocab]


SHARD_DDL = "part int, shard int, n_docs long, n_tokens long, image binary"
READ_DDL = "part int, shard int, place int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def write_shards(docs: DataFrame, vocab: str = VOCAB, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encodes docs (doc_id, text) and writes the images; returns the staged table of
    shards (part, shard, n_docs, n_tokens, image); (part, shard) ascend with doc_id."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, shard = encoder(vocab), TaskContext.get().partitionId(), 0
        bits = max(end_id, enc.size - 1).bit_length()
        doc_ids, lengths, parts, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            image = write_image(doc_ids, lengths, np.concatenate(parts), bits)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_docs": [len(doc_ids)], "n_tokens": [total], "image": pa.array([image], pa.binary())})

        for b in batches:
            at = 0
            for some in slices(b.column(1)):
                flat, n = enc.encode_slice(some)
                ids, own = b.column(0).slice(at, len(some)).to_pylist(), n + 1
                at += len(some)
                ends = np.cumsum(own)
                ended = np.full(int(ends[-1]), end_id, "<u4")
                inner = np.ones(len(ended), bool)
                inner[ends - 1] = False
                ended[inner] = flat
                lo = 0
                while lo < len(ids):  # a shard ends with the document that fills it
                    start = int(ends[lo - 1]) if lo else 0
                    hi = min(len(ids), int(np.searchsorted(ends, start + shard_tokens - total)) + 1)
                    doc_ids += ids[lo:hi]
                    lengths += own[lo:hi].tolist()
                    parts.append(ended[start:ends[hi - 1]])
                    total += len(parts[-1])
                    if total >= shard_tokens:
                        yield flush()
                        shard += 1
                        doc_ids, lengths, parts, total = [], [], [], 0
                    lo = hi
        if doc_ids:
            yield flush()

    # by the hash next to the id: rows of one id, or of none, are dealt to many tasks
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange(parallelism(docs.sparkSession), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    images = ordered.mapInArrow(run, SHARD_DDL)
    return staged(images, "tokens", **{"compression": "none", "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"})


def read_shards(shards: DataFrame) -> DataFrame:
    """Documents of the images: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32, from the decoded tokens."""
    ship(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                doc_ids, lengths, wm = read_image(b.column("image")[i].as_py())
                raw, ends = memoryview(wm.tokens().astype("<u4").tobytes()), np.cumsum(lengths)
                crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                same = lambda c, n=len(doc_ids), i=i, b=b: pa.array([b.column(c)[i].as_py()] * n, pa.int32())
                yield pa.RecordBatch.from_pydict({"part": same("part"), "shard": same("shard"), "place": pa.array(range(len(doc_ids)), pa.int32()), "doc_id": pa.array(doc_ids, pa.int64()), "local_start": pa.array(ends - lengths), "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crcs, pa.int64())})

    read = staged(shards.select("part", "shard", "image").mapInArrow(run, READ_DDL), "token-docs")
    # two levels of running totals, of what was read: parts are few, the shards of a part are its own
    head = staged(read.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n")), "token-shards")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = head.groupBy("part").agg(F.sum("n").alias("s")).select("part", F.coalesce(F.sum("s").over(before(Window.orderBy("part"))), F.lit(0)).alias("p0"))
    inside = head.select("part", "shard", F.coalesce(F.sum("n").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0)).alias("s0"))
    starts = inside.join(parts, "part")
    return read.join(starts, ["part", "shard"]).select("doc_id", (F.col("p0") + F.col("s0") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def export(shards: DataFrame, folder: str) -> int:
    """Writes images as files part-shard.cwm into a local folder, one at a time; returns how many."""
    os.makedirs(folder, exist_ok=True)
    n = 0
    for row in shards.select("part", "shard", "image").toLocalIterator():
        with open(os.path.join(folder, f"{row.part:06d}-{row.shard:06d}.cwm"), "wb") as f:
            f.write(row.image)
        n += 1
    return n


def read_file(path: str) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """An exported file, as read_image()."""
    with open(path, "rb") as f:
        return read_image(f.read())
