"""Byte-level BPE by prefix-sharing trie traversal.

For every prefix of a word there is one last token of its encoding: the token t that
ends the prefix such that (last token of the rest, t) stands together under the merge
ranks. So the distinct words of a batch are walked as a trie, in sorted order with a
stack of last-token states: each shared prefix is computed once, and a word's ids are
read off by stepping back through the states. Work is linear in the bytes of a word
times the longest token, also for one word that fills a whole text.

Words are cut as the byte-level pre-tokenizer cuts them. The strings of special tokens
in a text become their ids, as the library has it. Encodings of recent words are kept
per Python worker, twice CACHE_WORDS and half as many pieces at most.

Edge cases: null text encodes like the empty text, to no ids; no ids (or null) decode
to the empty text. Bytes that are not UTF-8 decode to U+FFFD. Ids outside the
vocabulary decode to nothing. Rows are independent; other columns pass through.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coded import Recent, distinct, per_text, slices, spread
from .env import free, ship

CACHE_WORDS = 150_000  # in each of two generations
CACHE_PAIRS = 300_000
SLICE_CHARS = 3_000_000  # encoded together
VOCAB = "byte_bpe_50k.json"

#: Unicode White_Space, spelled out so that no library's own idea of \s matters. Fixed values.
_WS = r"\t-\r \x85\xa0  -     　"
#: The pre-tokenizer's pattern. Fixed value.
_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"

#: Any white space, in RE2's syntax; more than _WS, as a text that matches twice only takes the longer way. Fixed values.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def vocab_path(name_or_path: str) -> str:
    """A file of the public tokenizers package by name, or any other path as it is."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Bpe:
    def __init__(self, path: str) -> None:
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        back = {c: b for b, c in enumerate(byte_chars())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        self.bytes_of = {v: bytes(back[c] for c in k) for k, v in ids.items()}
        size = max([*self.bytes_of, *self.special.values()]) + 1
        self.rank, self.halves = [-1] * size, [None] * size
        self.pair_rank: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b, t = ids[left], ids[right], ids[left + right]
            self.pair_rank.setdefault(a << 20 | b, r)
            if self.halves[t] is None:
                self.rank[t], self.halves[t] = r, (a, b)
        self.together: dict[int, bool] = {}
        # a token counts only if its own bytes encode to it
        sound = [True] * size
        for t in sorted(self.bytes_of, key=self.rank.__getitem__):
            if self.halves[t] is not None:
                a, b = self.halves[t]
                sound[t] = sound[a] and sound[b] and self._compatible(a, b, self.rank[t])
        self.token = {v: k for k, v in self.bytes_of.items() if sound[k] and (self.halves[k] is not None or len(v) == 1)}
        self.longest = max(map(len, self.token))
        self.decoded = self.bytes_of | {v: k.encode() for k, v in self.special.items()}
        self.pieces = regex.compile(_PIECES).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.odd = "|".join([_SPACE + "{2}", *(re.sub(r"(\W)", r"\\\1", x) for x in self.special)])
        self.table = [self.decoded.get(i, b"") for i in range(size)]
        self.known, self.known_pieces = Recent(CACHE_WORDS), Recent(CACHE_WORDS // 2)

    def _compatible(self, a: int, b: int, limit: int) -> bool:
        """Whether a and b stay apart: taking their merges back from the last on, no
        pair across the border would have been merged before the merge taken back.
        Equal ranks merge from the left."""
        rank = self.rank
        while True:
            r = self.pair_rank.get(a << 20 | b)
            if r is not None and r < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.halves[a][1]
            else:
                limit, b = rb + 1, self.halves[b][0]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Encodings (32-bit ids) of distinct words, by depth-first traversal of their trie."""
        out, token, together, longest, before = {}, self.token, self.together, self.longest, b""
        last = [0] * (1 + max(map(len, words), default=0))  # last[i]: of the first i bytes on the path
        width = [0] * len(last)  # its length in bytes
        if len(together) > CACHE_PAIRS:
            together.clear()
        for word in sorted(words):
            n, i = len(word), 0
            top = min(n, len(before))
            while i < top and word[i] == before[i]:
                i += 1
            for end in range(i + 1, n + 1):
                # one size fits; the last token grown by a byte is tried first
                grown = width[end - 1] + 1
                for size in (grown, *range(1, min(end, longest) + 1)):
                    t = token.get(word[end - size:end])
                    if t is None:
                        continue
                    if size == end:
                        break
                    key = last[end - size] << 20 | t
                    ok = together.get(key)
                    if ok is None:
                        ok = together[key] = self._compatible(key >> 20, t, 1 << 60)
                    if ok:
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
                last[end], width[end] = t, size
            ids, at = [], n
            while at:
                ids.append(last[at])
                at -= width[at]
            ids.reverse()
            out[word] = array("i", ids).tobytes()
            before = word
        return out

    def _learn(self, units: set[bytes], pieces: set[str]) -> None:
        """Encodes new units and pieces, all in one traversal."""
        cut, own = {}, self.pieces
        for key in units:  # the common shapes, word and word with a mark, need no pattern
            u = key.decode()
            if u.isalpha():
                cut[key] = (" " + u,)
            elif u[:-1].isalpha() and u[-1] in ".,;:!?":
                cut[key] = (" " + u[:-1], u[-1])
            else:
                cut[key] = own(u if u[:1] == "\n" else " " + u)
        new = self.known_pieces.missing(pieces.union(*cut.values()))
        now, known = self.known_pieces.now, self.known.now
        now.update((w.decode(), ids) for w, ids in self.encode_words([p.encode() for p in new]).items())
        for key, parts in cut.items():
            known[key] = now[parts[0]] if len(parts) == 1 else b"".join([now[p] for p in parts])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        flat, lengths = self.encode_array(pa.array(texts, pa.string()))
        return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        gc.disable()  # nothing here makes cycles, and the caches are large to walk
        try:
            found = [self._encode_slice(some) for some in slices(texts, SLICE_CHARS)]
        finally:
            gc.enable()
        return (np.concatenate([f for f, _ in found]), np.concatenate([n for _, n in found])) if found else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where no two white-space characters meet, no piece crosses from one word into
        the space before the next, so words encode alone, each with its space or line
        break before it; they are the units that are cached. Other texts, and those with
        special tokens, go piece by piece, as does the first word of each."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        offsets = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int64)
        words = lists.flatten()
        codes, keys = distinct(words)
        firsts = [self.pieces(w) for w in words.take(pa.array(offsets[:-1])).to_pylist()]
        hard = [self._hard(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        pieces = {p for ps in firsts for p in ps}.union(p for parts in hard for ps in parts if not isinstance(ps, int) for p in ps)
        units = np.ones(len(codes), bool)
        units[offsets[:-1]] = False
        used = np.zeros(len(keys), bool)
        used[codes[units]] = True
        self._learn(self.known.missing([k for k, u in zip(keys, used.tolist(), strict=True) if u]), pieces)
        get, get_piece = self.known.now.get, self.known_pieces.now.__getitem__
        table = [get(k, b"") if u else b"" for k, u in zip(keys, used.tolist(), strict=True)]
        # the first words come after the units in the table
        table += [b"".join(map(get_piece, ps)) for ps in firsts]
        codes = codes.astype(np.int64)
        codes[offsets[:-1]] = np.arange(len(keys), len(table))
        flat, each = spread(codes, table, np.int32)
        n = per_text(each, offsets)
        if odd.any():
            others = iter([np.frombuffer(b"".join(np.int32(x).tobytes() if isinstance(x, int) else b"".join(map(get_piece, x)) for x in parts), np.int32) for parts in hard])
            rows = iter(np.split(flat, np.cumsum(n)[:-1]))
            whole = [next(others) if o else next(rows) for o in odd]
            flat, n = np.concatenate(whole), np.array([len(x) for x in whole], np.int64)
        self.known.trim()
        self.known_pieces.trim()
        return flat, n

    def _hard(self, text: str) -> list:
        """Pieces of a text's segments, and ids of the special tokens between them."""
        return [self.special[s] if s in self.special else self.pieces(s) for s in (self.cut(text) if self.cut else [text]) if s]

    def decode(self, ids: list[int]) -> str:
        try:
            return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        except (IndexError, TypeError):
            return b"".join([self.decoded.get(i, b"") for i in ids]).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = {}


def loaded(vocab: str) -> Bpe:
    if vocab not in _loaded:
        _loaded[vocab] = Bpe(vocab_path(vocab))
    return _loaded[vocab]


def encode(docs: DataFrame, text: str = "text", out: str = "ids", vocab: str = VOCAB) -> DataFrame:
    """Adds array<int> of ids as column out, which replaces one of that name. vocab: a file name or path that workers can resolve."""
    ship(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        flat, n = loaded(vocab).encode_array(texts)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(flat))

    return docs.withColumn(out, F.arrow_udf(run, "array<int>")(F.col(f"`{text}`")))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", vocab: str = VOCAB) -> DataFrame:
    """Adds the text of array<int> ids as column out, which replaces one of that name."""
    ship(df.sparkSession)

    def run(lists: pa.Array) -> pa.Array:
        bpe = loaded(vocab)
        return pa.array([bpe.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else []) for x in lists], pa.string())

    return df.withColumn(out, F.arrow_udf(run, "string")(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, text: str = "text", vocab: str = VOCAB) -> DataFrame:
    """Adds ids and, from them, decoded, with underscores added to a name that is taken:
    encode and decode in one pass over the texts. (Two chained columns would have Spark encode twice, once for each use of ids.)"""
    ship(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        bpe, flats, counts, decoded = loaded(vocab), [], [], []
        for some in slices(texts, SLICE_CHARS):
            flat, n = bpe.encode_array(some)
            flats.append(flat)
            counts.append(n)
            ends = np.cumsum(n).tolist()
            decoded.append(pa.array([bpe.decode(flat[a:b].tolist()) for a, b in zip([0, *ends], ends, strict=False)], pa.string()))
        n = np.concatenate([np.zeros(1, np.int64), *counts])
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum(n), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *flats])))
        return pa.StructArray.from_arrays([ids, pa.concat_arrays(decoded) if decoded else pa.array([], pa.string())], ["ids", "decoded"])

    both, ids, decoded = free(docs, "_bpe", "ids", "decoded")
    out = docs.withColumn(both, F.arrow_udf(run, "struct<ids:array<int>,decoded:string>")(F.col(f"`{text}`")))
    return out.withColumns({ids: F.col(f"{both}.ids"), decoded: F.col(f"{both}.decoded")}).drop(both)


def digests(encoded: DataFrame, *more) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a table with ids and decoded, and more columns."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), *more,
    )
