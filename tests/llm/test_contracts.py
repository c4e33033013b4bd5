"""Every registered query over a small folder of tables, all its columns against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import ann, bpe, langid, pii, quality, recurrent_lm, token_file
from cairn.llm import queries as llm

from .test_operators import DDL, EDGE, SF, brute_base, brute_components, brute_links, brute_nearest, brute_stats, text

MAIL = "Write to ann.lee@mail.example.com or call +1 (743) 555-3824; card 4111 1111 1111 1111, host 10.0.0.255, 10.0.0.256. token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" DE89 3704 0044 0532 0130 00"
DOCS = [*EDGE, (20, MAIL, "en", "a", 9), (21, MAIL + " " + MAIL, "en", "b", 9), (22, text(1, 60) + " x", "fr", None, 9), (20, "again", None, None, None)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """documents with edge rows; the other tables as they are."""
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(DOCS, DDL).write.parquet(f"{folder}/documents.parquet")
    for t in ("embeddings", "pages", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


def rows(spark, sf, name):
    return llm.queries()[name](spark, sf).collect()


def same(got, want):
    assert sorted(got, key=str) == sorted(want, key=str)


def test_op2(spark, sf):
    tok = token_file.encoder(token_file.VOCAB).tok
    got = sorted(rows(spark, sf, "op2_wavelet_tokens"), key=lambda r: r.start)
    ids = lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 1]
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], [(d, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t, *_ in DOCS])
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0))


def test_op3(spark, sf):
    ok = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")), "card": lambda s: 13 <= sum(c.isdigit() for c in s) <= 19 and pii.luhn(re.sub("[^0-9]", "", s)), "phone": lambda s: 9 <= sum(c.isdigit() for c in s) <= 15}
    base = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    want = []
    for d, t, *_ in DOCS:
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in base.items() for m in re.finditer(p, t or "") if ok[k](m[0])]
        n = Counter(s.split(":")[0] for s in spans)
        want.append((d, *(n[k] for k in base), hashlib.sha256(",".join(spans).encode()).hexdigest(), ",".join(spans)))
    got = rows(spark, sf, "op3_pii")
    same([(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, ",".join(s for s in r.spans.split(",") if s.split(":")[0] in base)) for r in got], want)
    more = next(r for r in got if r.doc_id == 20 and r.n_email)
    assert [s.split(":")[0] for s in more.spans.split(",")][4:] == ["iban", "secret"] and more.n_spans == 6 == len(more.scores.split(","))
    assert sum(r.n_spans for r in got) == sum(len(r.spans.split(",")) for r in got if r.spans)


def test_op5(spark, sf):
    emb = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = rows(spark, sf, "op5_cross_polytope")
    want = brute_nearest(emb, lambda i: i % 100 == 0)
    exact = {(q, v): d for q, _, v, d in brute_nearest_all(emb)}
    assert Counter(r.query_id for r in got) == Counter(q for q, *_ in want)
    for q in {r.query_id for r in got}:
        own = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, len(own) + 1)) and [r[1:] for r in own] == sorted(r[1:] for r in own)
        assert all(exact[q, v] == pytest.approx(d, abs=1e-9) for _, d, v in own)


def brute_nearest_all(emb):
    return [(q, 0, v, float(np.sqrt(((x - y) ** 2).sum()))) for q, x in emb if q % 100 == 0 for v, y in emb if v != q]


def plain_language(words, pieces, probs):
    """Log-probability of words, all segmentations summed, position by position."""
    total = 0.0
    for w in words:
        w = langid.START + w
        a = [1.0] + [0.0] * len(w)
        for end in range(1, len(w) + 1):
            for k in range(max(0, end - 16), end):
                i = pieces.get(w[k:end], 0 if end - k == 1 else None)
                if i is not None:
                    a[end] += a[k] * probs[i]
        total += math.log(a[-1])
    return total


def plain_fit(words, pieces, n):
    probs = [1 / n] * n
    for _ in range(langid.ROUNDS):
        got = [0.0] * n
        for w, times in words.items():
            w = langid.START + w
            arcs = [(k, e, pieces.get(w[k:e], 0 if e - k == 1 else None)) for e in range(1, len(w) + 1) for k in range(max(0, e - 16), e)]
            arcs = [x for x in arcs if x[2] is not None]
            a, b = [1.0] + [0.0] * len(w), [0.0] * len(w) + [1.0]
            for k, e, i in arcs:
                a[e] += a[k] * probs[i]
            for k, e, i in sorted(arcs, key=lambda x: -x[0]):
                b[k] += probs[i] * b[e]
            for k, e, i in arcs:
                got[i] += times * a[k] * probs[i] * b[e] / a[-1]
        probs = [(g + langid.SMOOTH) / (sum(got) + langid.SMOOTH * n) for g in got]
        probs[0] = langid.EPS
    return [max(p, langid.EPS) for p in probs]


def test_op6(spark, tmp_path):
    import sentencepiece

    rng = np.random.default_rng(3)
    vocab = {"en": "the house of water stands where old people sing".split(), "de": "das Haus am Wasser steht wo alte Leute singen".split()}
    docs = [(i, " ".join(rng.choice(vocab[g], 6)), g) for i, g in enumerate(["en", "de"] * 12)] + [(90, None, "en"), (91, "12 !", "de"), (92, "wasser" * 20 + " steht", None), (None, "the the", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    sp = sentencepiece.SentencePieceProcessor(model_file=bpe.vocab_path(langid.VOCAB))
    keep = sorted({p for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and (p := sp.id_to_piece(i)) and len(p) <= 16})
    pieces = {p: i + 1 for i, p in enumerate(keep)}
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    probs = {g: plain_fit(Counter(w for d, t, own in docs if own == g and not held(d) for w in words(t)), pieces, len(keep) + 1) for g in ("de", "en")}
    want = {}
    for d, t, _ in docs:
        if not words(t):
            want[d] = (held(d), "und", 0.0)
            continue
        s = {g: plain_language(words(t), pieces, p) for g, p in probs.items()}
        best = min(s, key=lambda g: (-s[g], g))
        want[d] = (held(d), best, 1 / sum(math.exp(x - s[best]) for x in s.values()))
    for r in rows(spark, str(tmp_path), "op6_language"):
        assert (r.held_out, r.lang_pred) == want[r.doc_id][:2] and r.score == pytest.approx(want[r.doc_id][2], abs=1e-6)


def test_long_words_are_summed_whole():
    p = langid.Pieces(["a", "b", "ab", "ba", "▁", "▁a"])
    pieces = {x: i + 1 for i, x in enumerate(sorted(["a", "b", "ab", "ba", "▁", "▁a"]))}
    probs = np.random.default_rng(0).uniform(0.1, 0.9, (p.n, 2))
    probs[0] = langid.EPS
    for w in ("ab" * 30, "abba" * 40 + "c", "a" * 47, "a" * 48):
        got = langid.log_probs([w], p, probs)[0]
        assert np.allclose(got, [plain_language([w], pieces, probs[:, k]) for k in (0, 1)])
    words = Counter({"ab" * 40: 3, "abab": 5, "ba" * 33: 1})
    assert np.allclose(langid.fit(words, p), plain_fit(words, pieces, p.n))
    assert np.isfinite(langid.log_probs(["a" * 20000], p, probs)).all()


def test_op7(spark, sf):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.vocab_path(bpe.VOCAB))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids) for d, t, *_ in DOCS]
    same([tuple(r) for r in llm.queries()["op7_trie_bpe"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()], [(d, len(i), sha(",".join(map(str, i))), sha(tok.decode(i, skip_special_tokens=False))) for d, i in ids])


def test_op8(spark, sf):
    got = rows(spark, sf, "op8_recurrent_lm")
    same([(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got], brute_base([(d, t) for d, t, *_ in DOCS]))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    blocks = recurrent_lm.cut_blocks(docs.select("doc_id", "text").filter("length(text) < 3000 or text is null").coalesce(1))
    counts = recurrent_lm.count_words(blocks)
    m = recurrent_lm.train(blocks, counts, vocab=8)
    assert len(m.losses) == recurrent_lm.ROUNDS
    held = lambda d: recurrent_lm.is_held_out(d)
    count = Counter(w for d, t, *_ in DOCS if len(t or "") < 3000 and not held(d) for w in recurrent_lm.words_of(t))
    p, k = m.net.p, m.net.hidden
    want = []
    for _, t, *_ in DOCS:
        if len(t or "") >= 3000:
            continue
        h, before, total = np.zeros(k), m.end, 0.0
        for w in [*recurrent_lm.words_of(t), None]:
            x, u = p["in_"][before] + p["b"], h @ p["u"]
            z, r = 1 / (1 + np.exp(-(x[:k] + u[:k]))), 1 / (1 + np.exp(-(x[k:2 * k] + u[k:2 * k])))
            n = np.tanh(x[2 * k:] + r * u[2 * k:])
            h = n + z * (h - n)
            before = m.end if w is None else m.ids.get(w, m.other)
            c = m.net.class_of[before]
            lo, hi = m.net.cuts[c], m.net.cuts[c + 1]
            classes, inside = h @ p["wc"] + p["bc"], p["ww"][lo:hi] @ h + p["bw"][lo:hi]
            total += math.log10(np.exp(classes[c]) / np.exp(classes).sum() * np.exp(inside[before - lo]) / np.exp(inside).sum())
            if before == m.other:
                total += math.log10((count[w] + recurrent_lm.ALPHA) / m.rest)
        want.append(total)
    scores = sorted(r.score for r in recurrent_lm.score_blocks(blocks, counts, m).collect())
    assert np.allclose(scores, sorted(want), rtol=1e-4)


def test_op9(spark, sf):
    pairs = [(d, t) for d, t, *_ in DOCS]
    got = rows(spark, sf, "op9_near_duplicates")
    same([(r.doc_id, r.n_links) for r in got], brute_links(pairs))
    same([(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id != 20], [x for x in brute_components(pairs) if x[0] != 20])


def plain_distances(x):
    """The robust distances of one group in numpy: four starts, concentration, reweighting, shrinkage."""
    n, d = x.shape
    floor2 = np.array([quality.FLOOR[a] ** 2 for a in quality.STATS])
    mid = lambda v: np.sort(v, axis=0)[math.ceil(len(v) / 2) - 1]
    cov = lambda v: (v - v.mean(0)).T @ (v - v.mean(0)) / len(v)
    dist = lambda loc, s: np.einsum("ij,jk,ik->i", x - loc, np.linalg.inv(s + np.diag(floor2)), x - loc)
    q = mid(x)
    w = np.maximum(1.4826 * mid(np.abs(x - q)), np.sqrt(floor2))
    z = (x - q) / w
    u = z / np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-9)
    starts = [(q, np.diag(w * w)), (x.mean(0), cov(x)), (q, u.T @ u / n * np.outer(w, w)), (q, np.tanh(z).T @ np.tanh(z) / n * np.outer(w, w))]

    def step(e):
        d2 = dist(*e)
        near = x[d2 <= mid(d2)]
        return near.mean(0), cov(near)

    for _ in range(quality.TRIAL):
        starts = [step(e) for e in starts]
    e = min(starts, key=lambda e: np.linalg.slogdet(e[1] + np.diag(floor2))[1])
    for _ in range(quality.STEPS - quality.TRIAL):
        e = step(e)
    d2 = dist(*e)
    inner = x[d2 * quality.MEDIAN <= quality.INNER * max(mid(d2), 1e-9)]
    loc, s = inner.mean(0), cov(inner) * quality.INNER_FACTOR
    part = n / (n + quality.PRIOR_ROWS)
    prior = np.diag([quality.PRIOR_SD[a] ** 2 for a in quality.STATS])
    s = part * s + (1 - part) * (part * s + (1 - part) * prior)
    d2 = dist(loc, s)
    off = x - loc
    adds = off * (off @ np.linalg.inv(s + np.diag(floor2)))
    top = adds.argmax(1)
    bad = (off[np.arange(n), top] > 0) | (top == quality.STATS.index("v_len"))
    return np.where(bad, d2, 0.0)


def test_op10(spark, sf, tmp_path):
    got = rows(spark, sf, "op10_quality")
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], [(d, *brute_stats(t)) for d, t, *_ in DOCS])
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed) for r in got)
    # one group, against numpy
    rng = np.random.default_rng(8)
    clean = lambda: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) + ("." if rng.random() < 0.1 else "") for _ in range(int(rng.integers(40, 200))))
    texts = [clean() for _ in range(90)] + ["".join(c + ("#" if rng.random() < 0.4 else "") for c in clean()) for _ in range(6)] + [" ".join("x" * 40 + str(i) for i in range(60))]
    docs = spark.createDataFrame([(i, t, "en", "a", 9) for i, t in enumerate(texts)], DDL)
    stats, far = quality._judged(docs)
    both = quality._vectors(stats).join(far, "_row").orderBy("doc_id").toPandas()
    want = plain_distances(both[list(quality.STATS)].to_numpy())
    assert len(both) == len(texts) and np.allclose(both.distance, want, rtol=1e-6)
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert [kept[i] for i in range(len(texts))] == (want <= quality.CUT).tolist() == [True] * 90 + [False] * 7


def test_small_tables_lean_on_the_prior(spark):
    """One, two or five clean documents stay; a clean document of a source of its own stays, a bad one beside many clean ones goes."""
    good = lambda i: (i, " ".join(f"word{(i * 7 + k) % 50} and" for k in range(30)), "en", "a", 9)
    for n in (1, 2, 5):
        assert quality.judge(spark.createDataFrame([good(i) for i in range(n)], DDL).withColumn("x", F.lit(1))).filter("kept or base_failed").count() == n
    rng = np.random.default_rng(2)
    many = [(i, " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(80)), "en", "a", 9) for i in range(150)]
    lone = [(500, many[0][1] + " more", "fr", "z", 9), (501, " ".join("$%#&|" * 3 + str(k) for k in range(60)), "de", "y", 9)]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(many + lone, DDL)).collect()}
    assert kept[500] and not kept[501] and all(kept[i] for i in range(150))


def test_chi2():
    assert quality.chi2_quantile(0.5, 7) == pytest.approx(6.3458, abs=1e-3) and quality.chi2_quantile(0.025, 7) == pytest.approx(16.0128, abs=1e-3)


def test_hash_counts_follow_the_rows():
    assert ann.hashes_for(1000, 64) == 1 and ann.hashes_for(2**21, 64) == 2
