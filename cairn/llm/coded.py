"""Texts as Arrow arrays of words, each distinct word handled once in Python.

Edge cases: null texts count as empty ones, which have no words; a text longer than a
slice is a slice of its own, whole. Arrays of no texts give no slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CHARS = 8_000_000


class Recent:
    """Two generations of a cache: what is used moves to the younger; when that is full, the older goes."""

    def __init__(self, size: int) -> None:
        self.size, self.now, self.old = size, {}, {}

    def missing(self, keys) -> set:
        """Keys that neither generation has; those that the older has move on."""
        out, old, now = set(), self.old, self.now
        for k in [k for k in keys if k not in now]:
            v = old.get(k)
            if v is None:
                out.add(k)
            else:
                now[k] = v
        return out

    def trim(self) -> None:
        if len(self.now) > self.size:
            self.old, self.now = self.now, {}


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[pa.Array]:
    """Runs of texts of bounded bytes (one text at least); nulls become empty."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.cumsum(size) // chars
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield pc.fill_null(texts.slice(a, b - a), "")


def distinct(words: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """A code for every word, and the distinct words by code."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), raw_bytes(d.dictionary)


def raw_bytes(own: pa.Array) -> list[bytes]:
    """The values of a string or binary array without nulls."""
    if not len(own):
        return []
    kind = np.int64 if pa.types.is_large_string(own.type) or pa.types.is_large_binary(own.type) else np.int32
    at = np.frombuffer(own.buffers()[1], kind)[own.offset:own.offset + len(own) + 1].tolist()
    raw = own.buffers()[2].to_pybytes() if own.buffers()[2] is not None else b""
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def spread(codes: np.ndarray, table: list[bytes], kind) -> tuple[np.ndarray, np.ndarray]:
    """The arrays that table holds as bytes, laid end to end in the order of codes; and the length of each."""
    length = np.fromiter(map(len, table), np.int64, len(table)) // np.dtype(kind).itemsize
    return lay(codes, np.frombuffer(b"".join(table), kind), length)


def lay(codes: np.ndarray, flat: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As spread, for a table that stands end to end in flat."""
    start = np.cumsum(length) - length
    each = length[codes]
    end = np.cumsum(each)
    total = int(end[-1]) if len(end) else 0
    at = np.repeat(start[codes] - (end - each), each)
    at += np.arange(total)
    return flat[at], each


def per_text(each: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of each over the words of every text."""
    total = np.r_[0, np.cumsum(each)]
    return total[offsets[1:]] - total[offsets[:-1]]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space (empty ones may stand at the edges), and each text's offsets among them."""
    lists = pc.ascii_split_whitespace(texts)
    return lists.flatten(), np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int64)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (no nulls) end to end, and where each begins and the last ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    at = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]
