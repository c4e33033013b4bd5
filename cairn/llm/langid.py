"""Language ID by unigram piece models summed over all segmentations.

Each language has probabilities of the pieces of one fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, by the forward algorithm;
a text's is the product over its words. The probabilities are fitted by expectation
maximisation (forward-backward) on all words of a sample, at most DOCS_PER_LANG training
documents for each language. The model is languages x pieces in size. Every text is scored
whole; scores of recent words are kept in each Python worker, all words of a batch being
cut at once in numpy.

Words are runs of letters of any length, lower-cased. Those of up to SHORT letters, whose
probability a double holds, go side by side; longer ones one by one under a running
scale, by the same sum. A letter outside all pieces has the probability EPS.

Edge cases: null text or text without letters is 'und' with score 0, as is everything
when there is no labelled text to learn from. Ties go to the smallest language name.
Rows are independent; repeated rows get equal results.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import vocab_path
from .env import free, ship, staged

VOCAB = "piece_bpe_32k.model"
DOCS_PER_LANG, ROUNDS = 300, 3
SHORT, LONGEST_PIECE, EPS, SMOOTH = 48, 16, 1e-6, 0.05
CACHE_CELLS = 2_000_000
CHUNK = 4096  # letters of a long word whose pieces are looked up at once
SALTS = 64
START = "▁"
_B = np.uint64(0x9E3779B97F4A7C15)


def letter_runs(text: str) -> list[str]:
    import regex

    return regex.findall(r"\p{L}+", text.lower())


class Pieces:
    """The vocabulary as 64-bit hashes by length; piece 0 is any other letter."""

    def __init__(self, pieces: list[str]) -> None:
        pieces = sorted({p for p in pieces if p and len(p) <= LONGEST_PIECE})
        self.n = len(pieces) + 1
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in range(1, LONGEST_PIECE + 1):
            own = [(i + 1, p) for i, p in enumerate(pieces) if len(p) == size]
            if own:
                h = self._hashes(self._codes([p for _, p in own]))[size][:, 0]
                order = np.argsort(h)
                self.by_size[size] = h[order], np.array([i for i, _ in own])[order]

    @staticmethod
    def _codes(words: list[str]) -> np.ndarray:
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64) + np.uint64(1)

    @staticmethod
    def _hashes(codes: np.ndarray) -> dict[int, np.ndarray]:
        length, out = codes.shape[1], {}
        h = np.zeros((len(codes), length), np.uint64)
        for size in range(1, min(length, LONGEST_PIECE) + 1):
            h = h[:, :length - size + 1] * _B + codes[:, size - 1:]
            h = h ^ (h >> np.uint64(31))
            out[size] = h
        return out

    def lattice(self, words: list[str]) -> dict[int, np.ndarray]:
        """For words of one length: size -> piece ids [word, start], -1 where none fits."""
        out = {}
        for size, h in self._hashes(self._codes(words)).items():
            ids = np.full(h.shape, -1, np.int64)
            if size in self.by_size:
                known, of = self.by_size[size]
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                ids = np.where(known[at] == h, of[at], -1)
            out[size] = np.where(ids < 0, 0, ids) if size == 1 else ids
        return out


_pieces: dict[str, Pieces] = {}


def pieces_of(vocab: str) -> Pieces:
    if vocab not in _pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocab_path(vocab))
        keep = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        _pieces[vocab] = Pieces(keep)
    return _pieces[vocab]


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def forward(lattice: dict[int, np.ndarray], probs: np.ndarray, rows: int, length: int) -> np.ndarray:
    """Probabilities [position, word, language] of all segmentations of the first letters; probs [piece, language]."""
    a = np.zeros((length + 1, rows, probs.shape[1]))
    a[0] = 1
    for end in range(1, length + 1):
        for size in range(1, min(end, LONGEST_PIECE) + 1):
            ids = lattice[size][:, end - size]
            fit = np.flatnonzero(ids >= 0)
            if len(fit):
                a[end, fit] += a[end - size, fit] * probs[ids[fit]]
    return a


def _chain(weights, length: int, langs: int) -> np.ndarray:
    """Logs of states 0..length [state, language]: state 0 is 1, and state e + 1 the sum over s of
    state e - s times weights(...)[e, s]. weights(lo, hi) gives them for lo <= e < hi. The last
    LONGEST_PIECE states are held under one scale, renewed as often, so nothing underflows."""
    out = np.zeros((length + 1, langs))
    last = np.zeros((LONGEST_PIECE, langs))  # newest first
    last[0], scale = 1.0, np.zeros(langs)
    for lo in range(0, length, CHUNK):
        w = weights(lo, min(length, lo + CHUNK))
        for i in range(len(w)):
            new = (last * w[i]).sum(0)
            last[1:] = last[:-1].copy()
            last[0] = new
            out[lo + i + 1] = np.log(new) + scale
            if i % LONGEST_PIECE == LONGEST_PIECE - 1:
                top = last.max(0)
                last /= top
                scale = scale + np.log(top)
    return out


def _piece_ids(word: str, pieces: Pieces, lo: int, hi: int, back: bool) -> np.ndarray:
    """[letter, s] ids of the pieces of s + 1 letters that end (back: start) at letters lo..hi-1, or -1."""
    a, b = (lo, min(len(word), hi + LONGEST_PIECE - 1)) if back else (max(0, lo - LONGEST_PIECE + 1), hi)
    lattice = pieces.lattice([word[a:b]])
    ids = np.full((hi - lo, LONGEST_PIECE), -1, np.int64)
    for size, row in lattice.items():
        at = np.arange(lo, hi) - a - (0 if back else size - 1)
        fit = (at >= 0) & (at < row.shape[1])
        ids[fit, size - 1] = row[0, at[fit]]
    return ids


def _weights(word: str, pieces: Pieces, probs: np.ndarray, back: bool = False):
    """weights(lo, hi) of _chain for the letters of a word in order, or back from its end."""
    n = len(word)

    def of(lo: int, hi: int) -> np.ndarray:
        ids = _piece_ids(word, pieces, n - hi, n - lo, True)[::-1] if back else _piece_ids(word, pieces, lo, hi, False)
        return np.where((ids >= 0)[:, :, None], probs[ids], 0.0)

    return of


def log_probs(words: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """[word, language] log probability of distinct words, all segmentations summed."""
    words = [START + w for w in words]
    out = np.zeros((len(words), probs.shape[1]))
    for length, of in _by_length(words).items():
        if length > SHORT:
            for i in of:
                out[i] = _chain(_weights(words[i], pieces, probs), length, probs.shape[1])[-1]
            continue
        for k in range(0, len(of), 20_000):
            some = of[k:k + 20_000]
            out[some] = np.log(forward(pieces.lattice([words[i] for i in some]), probs, len(some), length)[length])
    return out


def _expected(word: str, times: float, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Expected piece counts of one long word that stands so many times."""
    n, got = len(word), np.zeros(pieces.n)
    a = _chain(_weights(word, pieces, probs), n, 1)[:, 0]
    b = _chain(_weights(word, pieces, probs, True), n, 1)[::-1, 0]
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        ids = _piece_ids(word, pieces, lo, hi, True)
        at, size = np.nonzero(ids >= 0)
        own = ids[at, size]
        got += np.bincount(own, np.exp(a[lo + at] + b[lo + at + size + 1] - a[n]) * probs[own, 0] * times, pieces.n)
    return got


def fit(counts: Counter, pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from word counts, by forward-backward."""
    probs = np.full((pieces.n, 1), 1 / pieces.n)
    words, groups, long = sorted(counts), [], []
    for length, of in _by_length([START + w for w in words]).items():
        some = [START + words[i] for i in of]
        n = np.array([counts[words[i]] for i in of], float)
        if length > SHORT:
            long += zip(some, n.tolist(), strict=True)
        else:
            groups.append((length, pieces.lattice(some), n))
    for _ in range(rounds):
        got = np.zeros(pieces.n)
        for word, n in long:
            got += _expected(word, n, pieces, probs)
        for length, lattice, n in groups:
            a = forward(lattice, probs, len(n), length)[:, :, 0]
            b = np.zeros((length + 1, len(n)))
            b[length] = 1
            for start in range(length - 1, -1, -1):
                for size in range(1, min(length - start, LONGEST_PIECE) + 1):
                    ids = lattice[size][:, start]
                    on = np.flatnonzero(ids >= 0)
                    if len(on):
                        through = probs[ids[on], 0] * b[start + size, on]
                        b[start, on] += through
                        got += np.bincount(ids[on], a[start, on] * through / a[length, on] * n[on], pieces.n)
        probs = ((got + SMOOTH) / (got.sum() + SMOOTH * pieces.n))[:, None]
        probs[0] = EPS
    return np.maximum(probs[:, 0], EPS)


@dataclass
class Model:
    langs: list[str]
    probs: np.ndarray  # [piece, language]
    vocab: str
    name: str


def held_out() -> Column:
    """Whether doc_id is kept from training; a null one is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """(lang, text) of the docs_per_lang documents of each language that come first in the order of a
    hash of doc_id and text, of those that are not held out and have a lang and text. Rows equal in all
    three are one document, whatever their ids, so the bound holds for null and repeated ones."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = rows.withColumn("_h", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text"))
    # picked twice, within salts and then in all, so that no task gets a language's rows from everywhere; copies share a rank
    first = lambda of, *by: of.withColumn("_r", F.dense_rank().over(Window.partitionBy(*by).orderBy("_h"))).filter(F.col("_r") <= docs_per_lang)
    keys = rows.select("lang", "_h").distinct()
    chosen = staged(first(first(keys, F.col("lang"), F.pmod("_h", F.lit(SALTS))), F.col("lang")).select("lang", "_h"), "language-sample")
    # read from files, so Spark broadcasts it only if it is small
    return rows.select("lang", "_h", "text").join(chosen, ["lang", "_h"]).groupBy("lang", "_h").agg(F.first("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, vocab: str = VOCAB, docs_per_lang: int = DOCS_PER_LANG) -> Model:
    """Learns from docs (doc_id, text, lang) that are not held out and have a lang. Only
    the word counts of at most docs_per_lang documents for each language reach the driver."""
    ship(docs.sparkSession)
    texts = sample(docs, docs_per_lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c: Counter = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                c.update((lang, w) for w in letter_runs(text or ""))
            yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in c], pa.string()), "word": pa.array([k[1] for k in c], pa.string()), "n": pa.array(list(c.values()), pa.int64())})

    by: dict[str, Counter] = {}
    found = texts.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    for lang, word, n in zip(*(found.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
        by.setdefault(lang, Counter())[word] = n
    langs = sorted(by)
    pieces = pieces_of(vocab)
    probs = np.stack([fit(by[k], pieces) for k in langs], 1) if langs else np.zeros((pieces.n, 0))
    return Model(langs, probs, vocab, uuid.uuid4().hex)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.pieces = model, pieces_of(model.vocab)
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)))

    def _learn(self, words: list[list[str]]) -> None:
        new = {w for ws in words for w in ws if w not in self.known}
        if not new:
            return
        if (len(self.known) + len(new)) * len(self.model.langs) > CACHE_CELLS:
            self.known, self.scores, new = {}, self.scores[:0], {w for ws in words for w in ws}
        new = list(new)
        start = len(self.known)
        self.scores = np.concatenate((self.scores[:start], log_probs(new, self.pieces, self.model.probs)))
        self.known.update((w, start + i) for i, w in enumerate(new))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [letter_runs(t) if t else [] for t in texts]
        if not self.model.langs:
            return [("und", 0.0)] * len(texts)
        self._learn(words)
        get, out = self.known.__getitem__, []
        for ws in words:
            if not ws:
                out.append(("und", 0.0))
                continue
            total = self.scores[np.fromiter(map(get, ws), np.int64, len(ws))].sum(0)
            i = int(np.argmax(total))
            out.append((self.model.langs[i], min(1.0, 1 / math.fsum(np.exp(total - total[i])))))
        return out


_scorers: dict[str, Scorer] = {}


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Adds struct<lang,score>: the likeliest language and its posterior under equal priors.
    Its name is out, or with underscores added if that is taken."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        name = shared.value.name
        if name not in _scorers:
            _scorers.clear()
            _scorers[name] = Scorer(shared.value)
        found = []
        for k in range(0, len(texts), 500):
            found += _scorers[name].predict(texts.slice(k, 500).to_pylist())
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    return docs.withColumn(*free(docs, out), F.arrow_udf(run, "struct<lang:string,score:double>")(F.col(f"`{text}`")))
