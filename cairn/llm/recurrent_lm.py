"""Language-model scores from a gated recurrent network, beside a smoothed unigram base.

Counts cover every training document. Texts are cut once into blocks (a dictionary of
distinct words and a code per token); column blocks of words sum the training counts and
send each block its own words' counts back, so no count table is broadcast or collected.

The network is a GRU over the VOCAB most frequent tokens, one more for any other word,
and the end. Its softmax is factored by class; classes and first output biases come from the
corpus counts, and an other word costs its unigram share among the other words, so the
score is a probability of the whole text, unseen words being one more type as in the base.

Weights are learned in numpy by truncated backpropagation from every token of every training
document, once: in each of ROUNDS rounds every partition of blocks starts from the
common weights, runs over its next share of each block's documents, and the weights that
it comes to are averaged by tokens, in two levels of segments. The shares are staged as network
ids before the first round, in columns of their own, so a round reads its share alone. The driver gets one
set of weights a round, as large as the network, and no text. Scoring carries the state over all
of a document's windows, in lanes of documents that run side by side.

Edge cases: null or empty text is the end alone. Without training documents N and V are
0, the base is that of an unseen token, and the network stays as initialised. A null doc_id is not
held out. Repeated rows count as often as they stand and are scored alike.
"""

from __future__ import annotations

import bisect
import copy
import heapq
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coded import distinct, lay, per_text, split_words
from .env import give_back, one_thread, ship, staged

ALPHA = 0.1
VOCAB, CLASSES, HIDDEN = 2000, 48, 16
ROUNDS, LANES, WINDOW, RATE, SEED = 4, 512, 16, 0.01, 7
STEPS = 50  # of a share of a block, at least, if it has the tokens: fewer tokens go in fewer lanes
WARM = 20  # steps over which the rate rises in each round
SEGMENTS, FAN = 16, 64  # of the weights, and partitions averaged at once
SCORE_LANES, SCORE_LEAST, SCORE_WINDOW = 1024, 128, 32
CACHED = 1 << 16  # logits held at once
SAFE = 60.0  # logits up to here need no shift before exp
PLACES = 12  # rows of an id that are summed by their place
BLOCK_CHARS = 12_000_000
COLUMN_WORDS = 300_000


# ---- the network ----

class Gru:
    """Token ids 0..size-1; classes are runs of ids. in_ row = a token's input to the three gates."""

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = SEED) -> None:
        rng, size = np.random.default_rng(seed), len(counts)
        weight = np.sqrt(counts + 1.0)
        at = np.minimum((np.cumsum(weight) - weight / 2) / weight.sum() * classes, classes - 1).astype(int)
        self.class_of = np.unique(at, return_inverse=True)[1]
        n = int(self.class_of[-1]) + 1
        self.cuts = np.searchsorted(self.class_of, np.arange(n + 1))
        share = np.log((counts + 0.5) / (counts + 0.5).sum())
        self.p = {
            "in_": rng.normal(0, 0.1, (size, 3 * hidden)), "u": rng.normal(0, 0.4 / np.sqrt(hidden), (hidden, 3 * hidden)), "b": np.zeros(3 * hidden),
            "wc": rng.normal(0, 0.05, (hidden, n)), "bc": np.array([np.log(np.exp(share[a:b]).sum()) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]),
            "ww": rng.normal(0, 0.05, (size, hidden)), "bw": share,
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.hidden, self.key = hidden, np.uint16 if size <= 1 << 16 else np.int64

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        ends = np.cumsum([v.size for v in self.p.values()])
        self.p = {k: part.reshape(v.shape).astype(np.float32, copy=False) for (k, v), part in zip(self.p.items(), np.split(flat, ends[:-1]), strict=True)}

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """By gate (update, reset, new): each token's inputs and the recurrent weights, times -1, -1 and 2, as step() wants them."""
        p, k, made = self.p, self.hidden, []
        for w, b in ((p["in_"], p["b"]), (p["u"], None)):
            by = np.empty((3, len(w), k), w.dtype)
            for g, factor in enumerate((-1, -1, 2)):
                np.multiply(w[:, g * k:(g + 1) * k], factor, out=by[g])
                if b is not None:
                    by[g] += b[g * k:(g + 1) * k] * factor
            made.append(by)
        return tuple(made)

    def outputs(self) -> tuple:
        """For the classes and for the tokens: output weights with the bias as the last column, and with ones
        in its place; and whether all logits are small enough for exp as they are (a state is within -1 and 1)."""
        p, made = self.p, []
        for w, b in ((p["wc"].T, p["bc"]), (p["ww"], p["bw"])):
            w = np.column_stack([w, b])
            one = w.copy()
            one[:, -1] = 1
            made.append((w, one))
        return *made, all(float(np.abs(w).sum(1).max()) < SAFE for w, _ in made)

    def step(self, h: np.ndarray, x: np.ndarray, u: np.ndarray, new: np.ndarray, zr: np.ndarray, n: np.ndarray, hu: np.ndarray) -> None:
        """Writes the next state, from the tokens' inputs by gate, into new, and what the way back needs into the
        last three: both gates, the new value, the products with u. Overflow of exp gives the right limits."""
        np.matmul(h, u, out=hu)
        np.add(x[:2], hu[:2], out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)  # the logistic function, as inputs and u are negative here
        np.multiply(zr[1], hu[2], out=n)
        n += x[2]
        np.exp(n, out=n)
        n += 1
        np.divide(-2, n, out=n)
        n += 1  # tanh, as inputs and u are doubled here
        np.subtract(h, n, out=new)
        new *= zr[0]
        new += n

    @staticmethod
    def _softmax(x: np.ndarray, w: np.ndarray, one: np.ndarray, own: np.ndarray, runs: list, safe: bool, grad: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log-probability of row own of w for each row of x. A run (s, e, lo, hi): rows s to e of x choose among rows lo to hi of w.
        With grad, adds the mean loss's gradient of w to it and returns that of x. Runs go in groups that stay in the cache;
        exponentials are never divided by their sums, the narrow products are."""
        m, mine = len(x), w.take(own, 0)
        logs, dx = np.einsum("ij,ij->i", x, mine), None if grad is None else np.empty_like(x)
        runs = [(a, min(a + max(1, CACHED // (hi - lo)), e), lo, hi) for s, e, lo, hi in runs for a in range(s, e, max(1, CACHED // (hi - lo)))]
        s, e, lo, hi = np.array(runs).T
        rows, wide = e - s, hi - lo
        ends = np.cumsum(rows * wide)
        at = ends - rows * wide
        if grad is not None:
            place = np.repeat(at - lo - wide * s, rows)
            place += np.repeat(wide, rows) * np.arange(m)
            place += own
        ends, at, i = ends.tolist(), at.tolist(), 0
        while i < len(runs):
            j = max(i + 1, bisect.bisect_right(ends, at[i] + CACHED))
            first, last = runs[i][0], runs[j - 1][1]
            a, group = np.empty(ends[j - 1] - at[i], x.dtype), []
            for (s, e, lo, hi), o, end in zip(runs[i:j], at[i:j], ends[i:j], strict=True):
                v = a[o - at[i]:end - at[i]].reshape(e - s, hi - lo)
                np.matmul(x[s:e], w[lo:hi].T, out=v)
                group.append((v, s, e, lo, hi))
            if not safe:
                for v, s, e, _, _ in group:
                    top = v.max(1)
                    v -= top[:, None]
                    logs[s:e] -= top
            np.exp(a, out=a)
            if grad is None:
                total = np.concatenate([v @ one[lo:hi, -1] for v, _, _, lo, hi in group])
            else:
                for v, s, e, lo, hi in group:
                    np.matmul(v, one[lo:hi], out=dx[s:e])
                total = dx[first:last, -1].copy()
                scale = (1 / m / total)[:, None]
                dx[first:last] *= scale
                a[place[first:last] - at[i]] -= total
                xs = x[first:last] * scale
                for v, s, e, lo, hi in group:
                    grad[lo:hi] += v.T @ xs[s - first:e - first]
            logs[first:last] -= np.log(total)
            i = j
        if grad is not None:
            mine *= 1 / m
            dx -= mine
        return logs, dx

    def log_probs(self, hs: np.ndarray, targets: np.ndarray, outputs: tuple, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural-log probabilities of targets; with grads, adds those of the mean loss and returns that of hs."""
        (wc, wc1), (ww, ww1), safe = outputs
        m, k, n = len(targets), self.hidden, len(self.cuts) - 1
        cls = self.class_of[targets]
        order = np.argsort(cls.astype(self.key), kind="stable")
        targets, cls = targets[order], cls[order]
        x = np.empty((m, k + 1), hs.dtype)
        x[:, :k], x[:, k] = hs.take(order, 0), 1
        cut = np.searchsorted(cls, np.arange(n + 1)).tolist()
        inner = [r for r in zip(cut, cut[1:], self.cuts.tolist(), self.cuts[1:].tolist(), strict=False) if r[0] < r[1]]
        gc, gw = (None, None) if grads is None else (np.zeros_like(wc), np.zeros_like(ww))
        logs, dx = self._softmax(x, wc, wc1, cls, [(0, m, 0, n)], safe, gc)
        more, dy = self._softmax(x, ww, ww1, targets, inner, safe, gw)
        out = np.empty_like(logs)
        out[order] = logs + more
        if grads is None:
            return out, None
        grads["wc"] += gc[:, :k].T
        grads["bc"] += gc[:, k]
        grads["ww"] += gw[:, :k]
        grads["bw"] += gw[:, k]
        back = np.empty_like(order)
        back[order] = np.arange(m)
        dx += dy
        return out, dx.take(back, 0)[:, :k]

    def window(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Loss, gradients (truncated at the window's start) and last state of one window
        [time, lane]; fresh marks the tokens before which a lane's state is cleared."""
        p, k, (times, lanes) = self.p, self.hidden, inputs.shape
        grads = {n: np.zeros_like(v) for n, v in p.items()}
        space = lambda *by: np.empty((*by, lanes, k), h.dtype)
        before, hs, zr, n, kept, dx = space(times), space(times), space(times, 2), space(times), space(times), space(3, times)
        (tables, u), cleared, hu = self.gates(), [np.flatnonzero(f) for f in fresh], space(3)
        with np.errstate(over="ignore"):
            for t in range(times):
                before[t] = h
                before[t, cleared[t]] = 0
                self.step(before[t], tables.take(inputs[t], 1), u, hs[t], zr[t], n[t], hu)
                kept[t], h = hu[2], hs[t]
        logs, dhs = self.log_probs(hs.reshape(-1, k), targets.ravel(), self.outputs(), grads)
        dhs, du = dhs.reshape(times, lanes, k), np.zeros((3, k, k), h.dtype)
        ut = np.ascontiguousarray(u.swapaxes(1, 2)) * np.array([-1, -0.5, 0.5], h.dtype)[:, None, None]
        back, d, last, g, e = np.zeros_like(h), space(3), space(3), space(), space()
        for t in range(times - 1, -1, -1):
            (z, r), new = zr[t], n[t]
            np.add(dhs[t], back, out=g)
            np.multiply(g, z, out=back)
            g -= back
            np.subtract(before[t], new, out=d[0])
            d[0] *= z
            d[0] *= g
            np.multiply(new, new, out=e)
            np.subtract(1, e, out=e)
            g *= e
            np.multiply(g, r, out=d[2])
            np.subtract(1, r, out=d[1])
            d[1] *= d[2]
            d[1] *= kept[t]  # twice the reset gate's gradient, as products with u are doubled here
            dx[:2, t], dx[2, t] = d[:2], g
            du += np.matmul(before[t].T, d)
            np.matmul(d, ut, out=last)
            for x in last:
                back += x
            back[cleared[t]] = 0
        du[1] *= 0.5
        grads["u"] = du.swapaxes(0, 1).reshape(k, 3 * k)
        ids, sums = sums_by(inputs.ravel().astype(self.key), dx.reshape(3, -1, k))
        sums[:, k:2 * k] *= 0.5
        grads["in_"][ids] = sums
        grads["b"] = sums.sum(0)
        return -float(logs.mean()), grads, h

    def score(self, flat: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
        """Natural-log probability of each document; flat holds their targets one after another, the last of each the end.
        Documents are dealt out, the longest first, to the shortest lane, and a lane runs through its documents."""
        if not len(lengths):
            return np.zeros(0)
        lanes = int(min(len(lengths), np.clip(lengths.sum() // lengths.max(), SCORE_LEAST, SCORE_LANES)))
        heap, dealt = [(0, i) for i in range(lanes)], [[] for _ in range(lanes)]
        for i in np.argsort(-lengths, kind="stable").tolist():
            size, lane = heap[0]
            dealt[lane].append(i)
            heapq.heapreplace(heap, (size + int(lengths[i]), lane))
        sizes = np.array([size for size, _ in sorted(heap, key=lambda x: x[1])])
        long = np.argsort(-sizes, kind="stable")  # lanes that run longer come first
        sizes, dealt = sizes[long], [dealt[i] for i in long]
        docs, at = np.array([i for d in dealt for i in d]), np.cumsum(sizes) - sizes
        stream, each = lay(docs, flat, lengths)
        starts = np.cumsum(each) - each
        lane_of = np.repeat(np.arange(lanes), [len(d) for d in dealt])
        begin = starts - at[lane_of]
        by_time = np.argsort(begin, kind="stable")
        begin, lane_of = begin[by_time], lane_of[by_time]
        tables, u = self.gates()
        outputs, logs, k = self.outputs(), np.empty(len(stream), np.float32), self.hidden
        live = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left").tolist()
        first = np.searchsorted(begin, np.arange(len(live) + 1)).tolist()
        h, before = np.zeros((lanes, k), np.float32), np.full(lanes, end)
        with np.errstate(over="ignore"):
            for t0 in range(0, len(live), SCORE_WINDOW):
                hs, place, o = np.empty((sum(live[t0:t0 + SCORE_WINDOW]), k), np.float32), [], 0
                zr, n, hu = (np.empty((*by, live[t0], k), np.float32) for by in ((2,), (), (3,)))
                for t in range(t0, min(t0 + SCORE_WINDOW, len(live))):
                    m = live[t]
                    if m < len(n):
                        zr, n, hu = zr[:, :m], n[:m], hu[:, :m]
                    h = h[:m].copy() if t == t0 or first[t] < first[t + 1] else h[:m]
                    h[lane_of[first[t]:first[t + 1]]] = 0
                    self.step(h, tables.take(before[:m], 1), u, hs[o:o + m], zr, n, hu)
                    h, o = hs[o:o + m], o + m
                    place.append(at[:m] + t)
                    before = stream[place[-1]]
                place = np.concatenate(place)
                logs[place] = self.log_probs(hs, stream[place], outputs)[0]
        out = np.empty(len(lengths))
        out[docs] = np.add.reduceat(logs, starts, dtype=float)
        return out


def sums_by(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, and the sums of values [gate, row, unit] over the rows of each, gates side by side: many rows
    of an id in one product, few by their place among the rows of their id."""
    order = np.argsort(ids, kind="stable")
    ids, (gates, n, k) = ids[order], values.shape
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    count = np.diff(np.r_[first, n])
    most = np.argsort(-count, kind="stable")
    first, count = first[most], count[most]
    rows, ones = np.empty((n, gates * k), values.dtype), np.ones(n, values.dtype)
    for g in range(gates):
        rows[:, g * k:(g + 1) * k] = values[g].take(order, 0)
    out = rows.take(first, 0)
    many = int(np.searchsorted(-count, -PLACES, side="left"))
    for i, (a, c) in enumerate(zip(first[:many].tolist(), count[:many].tolist(), strict=True)):
        out[i] = ones[:c] @ rows[a:a + c]
    for j in range(1, PLACES):
        m = int(np.searchsorted(-count, -j, side="left"))
        if m > many:
            out[many:m] += rows.take(first[many:m] + j, 0)
    return ids[first], out


class Adam:
    """Adam with clipped gradients on a network's weights, which become views of one array."""

    def __init__(self, net: Gru, rate: float) -> None:
        self.names, self.rate, self.steps, self.w = list(net.p), rate, 0, net.flat()
        net.load(self.w)
        self.m, self.v = np.zeros_like(self.w), np.zeros_like(self.w)

    def step(self, grads: dict) -> None:
        self.steps += 1
        g = np.concatenate([grads[n].ravel() for n in self.names])
        g *= min(1.0, 1.0 / max(1e-9, float(np.sqrt(g @ g))))
        m, v = self.m, self.v
        m *= 0.9
        v *= 0.99
        d = g * 0.1
        m += d
        g *= g
        g *= 0.01
        v += g
        np.multiply(v, 1 / (1 - 0.99**self.steps), out=d)
        np.sqrt(d, out=d)
        d += 1e-8
        np.divide(m, d, out=d)
        d *= self.rate * min(1.0, self.steps / WARM) / (1 - 0.9**self.steps)
        self.w -= d


def learn(net: Gru, adam: Adam, targets: np.ndarray, lengths: np.ndarray, end: int) -> float:
    """One pass of truncated backpropagation over documents that stand end to end, in lanes. Returns the
    sum of the losses. The last lane is filled up from the first documents."""
    if not len(targets):
        return 0.0
    lanes = max(1, min(LANES, len(targets) // (WINDOW * STEPS)))
    length = -(-len(targets) // lanes)
    fresh = np.zeros(len(targets), bool)
    fresh[np.cumsum(lengths) - lengths] = True
    before = np.where(fresh, end, np.r_[end, targets[:-1]])
    x, y, fresh = (np.resize(v, lanes * length).reshape(lanes, length).T for v in (before, targets, fresh))
    fresh = fresh.copy()
    fresh[0] = True
    h, total = np.zeros((lanes, net.hidden), np.float32), 0.0
    for t in range(0, length, WINDOW):
        loss, grads, h = net.window(h, x[t:t + WINDOW], y[t:t + WINDOW], fresh[t:t + WINDOW])
        adam.step(grads)
        total += loss * x[t:t + WINDOW].size
    return total


# ---- the corpus ----

BLOCK_DDL = "block long, n_words long, n_train long, docs binary, lengths binary, codes binary, words binary, train binary"


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _pack(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x)


def _unpack(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(x)


def cut_blocks(docs: DataFrame) -> DataFrame:
    """Staged blocks of whole documents: ids (with a null mask and held-out flags),
    token counts, codes into the block's dictionary, its words, and how often each occurs in training documents."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        ids, texts, chars = [], [], 0

        def flush() -> pa.RecordBatch:
            cut, at = split_words(pc.ascii_lower(pa.concat_arrays(texts)))
            filled = pc.greater(pc.binary_length(cut), 0)
            n = per_text(filled.to_numpy(zero_copy_only=False).astype(np.int64), at)
            flat, known = distinct(cut.filter(filled))
            held = np.array([is_held_out(d) for d in ids])
            train = np.bincount(flat[~np.repeat(held, n)], minlength=len(known)).astype("<u4")
            packed = np.array([[d is not None, held[i], d or 0] for i, d in enumerate(ids)], "<i8")
            return pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "n_words": pa.array([len(known)], pa.int64()), "n_train": pa.array([int((~held).sum())], pa.int64()), "docs": pa.array([_pack(packed.tobytes())], pa.binary()), "lengths": pa.array([_pack(n.astype("<u4").tobytes())], pa.binary()),
                "codes": pa.array([_pack(flat.astype("<u4").tobytes())], pa.binary()), "words": pa.array([_pack(b" ".join(known))], pa.binary()), "train": pa.array([_pack(train.tobytes())], pa.binary())})

        for b in batches:
            own, text = b.column(0).to_pylist(), pc.fill_null(b.column(1), "")
            ends, s = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while s < len(own):
                done = int(ends[s - 1]) if s else 0
                e = min(len(own), int(np.searchsorted(ends, done + BLOCK_CHARS - chars)) + 1)
                ids += own[s:e]
                texts.append(text.slice(s, e - s))
                chars += int(ends[e - 1]) - done
                s = e
                if chars >= BLOCK_CHARS:
                    yield flush()
                    block += 1
                    ids, texts, chars = [], [], 0
        if ids:
            yield flush()

    return staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK_DDL), "lm-blocks")


def count_words(blocks: DataFrame, vocab: int = VOCAB) -> DataFrame:
    """Staged rows of column blocks: kind 'sum' (n, v), 'top' (word, n) and, for each
    block, 'back' (payload: code and count of its words that the column block has)."""
    size = blocks.agg(F.sum("n_words")).first()[0] or 0
    columns = max(1, -(-size // COLUMN_WORDS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for row in b.to_pylist():
                words, train = _unpack(row["words"]).split(), np.frombuffer(_unpack(row["train"]), "<u4")
                col = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)) % np.uint64(columns)
                order = np.argsort(col, kind="stable")
                cut = np.searchsorted(col[order], np.arange(columns + 1)).tolist()
                to = [(c, order[i:j]) for c, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if i < j]
                yield pa.RecordBatch.from_pydict({"col": pa.array([c for c, _ in to], pa.int32()), "block": pa.array([row["block"]] * len(to), pa.int64()), "words": pa.array([b" ".join([words[i] for i in at.tolist()]) for _, at in to], pa.binary()), "codes": pa.array([at.astype("<u4").tobytes() for _, at in to], pa.binary()), "train": pa.array([train[at].tobytes() for _, at in to], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        cut = pc.split_pattern(table.column("words").combine_chunks(), b" ")
        codes, words = distinct(cut.flatten())
        # whole numbers below 2**53, so exact
        sums = np.bincount(codes, np.frombuffer(b"".join(table.column("train").to_pylist()), "<u4"), len(words)).astype("<i8")
        seen = np.flatnonzero(sums)
        most = seen if len(seen) <= vocab else seen[sums[seen] >= np.partition(sums[seen], -vocab)[-vocab]]
        top = sorted(((int(sums[i]), words[i]) for i in most.tolist()), key=lambda x: (-x[0], x[1]))[:vocab]
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
        back = [c + s.tobytes() for c, s in zip(table.column("codes").to_pylist(), np.split(sums[codes], ends[:-1]), strict=True)]
        k = len(back)
        return pa.table({
            "kind": ["sum"] + ["top"] * len(top) + ["back"] * k, "block": pa.array([None] * (1 + len(top)) + table.column("block").to_pylist(), pa.int64()),
            "word": pa.array([None] + [w for _, w in top] + [None] * k, pa.binary()), "n": pa.array([int(sums.sum())] + [n for n, _ in top] + [None] * k, pa.int64()),
            "v": pa.array([len(seen)] + [None] * (len(top) + k), pa.int64()), "payload": pa.array([None] * (1 + len(top)) + back, pa.binary())})

    sent = blocks.select("block", "words", "train").mapInArrow(send, "col int, block long, words binary, codes binary, train binary")
    return staged(sent.groupBy("col").applyInArrow(total, "kind string, block long, word binary, n long, v long, payload binary"), "lm-counts")


@dataclass
class Model:
    net: Gru
    ids: dict[bytes, int]  # of the vocabulary
    other: int
    end: int
    n: int  # training tokens
    v: int  # distinct ones
    ends: int  # training documents
    rest: float  # the smoothed mass of other words
    name: str
    losses: list[float]


WEIGHTS_DDL = "seg int, part int, tokens long, loss double, weights binary"


def read_block(row: dict) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """A block's words, its documents (known, held out, id), their lengths with the end, and
    the codes of all tokens; the end's code is the number of words."""
    words = _unpack(row["words"]).split()
    docs = np.frombuffer(_unpack(row["docs"]), "<i8").reshape(-1, 3)
    n = np.frombuffer(_unpack(row["lengths"]), "<u4").astype(np.int64) + 1
    flat = np.full(int(n.sum()), len(words), np.int64)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(n) - 1] = False
    flat[inner] = np.frombuffer(_unpack(row["codes"]), "<u4")
    return words, docs, n, flat


def train(blocks: DataFrame, counts: DataFrame, vocab: int = VOCAB, rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Learns from all training documents of the blocks. The driver gets the vocabulary's counts, and the weights once a round."""
    both = counts.filter("kind = 'sum'").agg(F.sum("n"), F.sum("v")).first()
    words, types = int(both[0] or 0), int(both[1] or 0)
    ends = int(blocks.agg(F.sum("n_train")).first()[0] or 0)
    top = counts.filter("kind = 'top'").orderBy(F.desc("n"), "word").limit(vocab).select("word", "n").collect()
    known = [(int(r.n), bytes(r.word)) for r in top]
    rest_n, rest_v = words - sum(n for n, _ in known), types - len(known)
    # ids by falling count, the end and the other word among them
    rows = sorted([*known, (ends, None), (rest_n, 0)], key=lambda x: -x[0])
    net = Gru(np.array([n for n, _ in rows], float))
    ids = {w: i for i, (_, w) in enumerate(rows) if isinstance(w, bytes)}
    end, other = (next(i for i, (_, w) in enumerate(rows) if not isinstance(w, bytes) and w == k) for k in (None, 0))
    model = Model(net, ids, other, end, words + ends, types + (ends > 0), ends, rest_n + ALPHA * (rest_v + 1), uuid.uuid4().hex, [])
    tokens = _tokens(blocks, model, rounds)
    for r in range(rounds):
        one = staged(_averaged(_round(tokens, model, r, rate * (1 - 0.8 * r / max(rounds - 1, 1)))), "lm-weights").orderBy("seg").collect()
        if not one:  # no training document in this share
            continue
        net.load(np.concatenate([np.frombuffer(x.weights, "<f4") for x in one]))
        model.losses.append(one[0].loss / one[0].tokens)
    return model


def _tokens(blocks: DataFrame, model: Model, rounds: int) -> DataFrame:
    """Staged network ids of every block's training documents, in a pair of columns a round (lengths, ids):
    round r has the documents whose place in the block is r modulo rounds, and reads its columns alone."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for row in b.to_pylist():
                words, docs, n, flat = read_block(row)
                ids = np.array([*(m.ids.get(w, m.other) for w in words), m.end], m.net.key)[flat]
                out = {}
                for r in range(rounds):
                    mine = np.flatnonzero((docs[:, 1] == 0) & (np.arange(len(docs)) % rounds == r))
                    mine = np.random.default_rng([SEED, r, row["block"] & 0xFFFFFFFF]).permutation(mine)
                    own, each = lay(mine, ids, n)
                    out |= {f"n{r}": pa.array([_pack(each.astype("<i8").tobytes())], pa.binary()), f"t{r}": pa.array([_pack(own.tobytes())], pa.binary())}
                yield pa.RecordBatch.from_pydict(out)
        give_back()

    ddl = ", ".join(f"n{r} binary, t{r} binary" for r in range(rounds))
    return staged(blocks.select("block", "docs", "lengths", "codes", "words").mapInArrow(run, ddl), "lm-tokens")


def _round(tokens: DataFrame, model: Model, r: int, rate: float) -> DataFrame:
    """Each partition's weights after its share of round r."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        one_thread()
        m, part = shared.value, TaskContext.get().partitionId()
        net = copy.deepcopy(m.net)
        adam, seen, loss = Adam(net, rate), 0, 0.0
        for b in batches:
            for lengths, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                targets = np.frombuffer(_unpack(ids), net.key).astype(np.int64)
                loss += learn(net, adam, targets, np.frombuffer(_unpack(lengths), "<i8"), m.end)
                seen += len(targets)
        give_back()
        if seen:
            parts = np.array_split(net.flat(), SEGMENTS)
            yield pa.RecordBatch.from_pydict({"seg": pa.array(range(SEGMENTS), pa.int32()), "part": pa.array([part] * SEGMENTS, pa.int32()), "tokens": [seen] * SEGMENTS, "loss": [loss] * SEGMENTS, "weights": [p.astype("<f4").tobytes() for p in parts]})

    return tokens.select(f"n{r}", f"t{r}").mapInArrow(run, WEIGHTS_DDL)


def _averaged(weights: DataFrame) -> DataFrame:
    """Means by tokens of each segment: of FAN partitions, then of those."""

    def mean(table: pa.Table) -> pa.Table:
        n = np.array(table.column("tokens").to_pylist(), float)
        total = sum(k * np.frombuffer(v.as_buffer(), "<f4").astype(float) for k, v in zip(n, table.column("weights"), strict=True))
        return pa.table({"seg": table.column("seg").slice(0, 1), "part": pa.array([int(table.column("part")[0].as_py()) // FAN], pa.int32()), "tokens": [int(n.sum())], "loss": [float(sum(table.column("loss").to_pylist()))], "weights": [(total / n.sum()).astype("<f4").tobytes()]})

    first = weights.groupBy("seg", F.floor(F.col("part") / FAN)).applyInArrow(mean, WEIGHTS_DDL)
    return first.groupBy("seg").applyInArrow(mean, WEIGHTS_DDL)


SCORE_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_blocks(blocks: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(own: pa.Table, back: pa.Table) -> pa.Table:
        one_thread()
        m, parts = shared.value, []
        for row in own.to_pylist():
            words, docs, n, flat = read_block(row)
            count = np.zeros(len(words) + 1, np.int64)
            for raw in back.column("payload").to_pylist():
                k = len(raw) // 12
                count[np.frombuffer(raw, "<u4", k)] = np.frombuffer(raw, "<i8", k, 4 * k)
            count[-1] = m.ends
            ends = np.cumsum(n) - 1
            sums = lambda values: np.add.reduceat(values[flat], ends - n + 1)  # noqa: E731, B023
            base = np.log10((count + ALPHA) / (m.n + ALPHA * (m.v + 1)))
            ids = np.fromiter((m.ids.get(w, m.other) for w in words), np.int64, len(words))
            ids = np.r_[ids, m.end]
            extra = np.where(ids == m.other, np.log10((count + ALPHA) / m.rest), 0.0)
            net = m.net.score(ids[flat], n, m.end) / np.log(10)
            give_back()
            parts.append(pa.table({
                "doc_id": pa.array([int(d) if k else None for k, _, d in docs], pa.int64()), "held_out": pa.array(docs[:, 1] != 0), "n_tokens": pa.array(n), "n_known": pa.array(sums((count > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(n), m.n)), "base_score": pa.array(sums(base)), "score": pa.array(net + sums(extra))}))
        return pa.concat_tables(parts) if parts else pa.table({c: pa.array([], t) for c, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))})

    back = counts.filter("kind = 'back'").select("block", "payload")
    return blocks.select("block", "docs", "lengths", "codes", "words").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, SCORE_DDL)


def score_texts(docs: DataFrame, **options) -> DataFrame:
    """docs (doc_id, text) to doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select("doc_id", "text")
    blocks = cut_blocks(docs)
    counts = count_words(blocks)
    return score_blocks(blocks, counts, train(blocks, counts, **options))
