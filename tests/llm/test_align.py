"""Alignment against the tokenizers' own libraries and plain loops over token pairs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.llm import align, bpe
from cairn.llm import queries as llm

from .test_operators import DDL, EDGE, text

ODD = ["a▁b", " lead", "trail ", "two  spaces   three", "a\nb \n c", "\t", " ", "  ", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00 \x01", "ﬁ é ① é ﻿​ x", "漢字\U0001F600\U0001F468‍\U0001F469", " a　 b", "don't it's we'll 12345 3.14", "▁", "x" * 3000]
ROWS = [*EDGE, *[(100 + i, t, "en", "a", 1) for i, t in enumerate(ODD)], (130, text(1, 60), "en", "a", 1), (None, "a b", "en", "a", 1)]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(bpe.vocab_path(align.A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=bpe.vocab_path(align.B))


def plain(libraries, t):
    """Ids of A and B, groups, links by pairs of byte ranges."""
    a, b = libraries
    back = {c: i for i, c in enumerate(bpe.byte_chars())}
    e = a.encode(" " + (t or ""), add_special_tokens=False)
    ids_b = b.encode(t or "")
    of_a = [bytes(back[c] for c in x) for x in e.tokens]
    of_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) and b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    whole = (" " + t).encode() if t else b""
    if not t or b"".join(of_a) != whole or b"".join(of_b) != whole:
        return [], [], [], []
    ranges = lambda parts: [(end - len(p), end) for p, end in zip(parts, np.cumsum([len(p) for p in parts]).tolist(), strict=True)]
    ra, rb = ranges(of_a), ranges(of_b)
    cuts = sorted({e for _, e in ra} & {e for _, e in rb})
    groups = [([i for i, (_, e) in zip(e_ids, ra, strict=True) if lo < e <= hi], [i for i, (_, e) in zip(ids_b, rb, strict=True) if lo < e <= hi]) for e_ids in [e.ids] for lo, hi in zip([0, *cuts], cuts, strict=False)] if len(whole) < 2000 else None
    links, j = [], 0
    for i, (s, x) in zip(e.ids, ra, strict=True):
        while rb[j][1] <= s:
            j += 1
        k = j
        while k < len(rb) and rb[k][0] < x:
            links.append((i, ids_b[k]))
            k += 1
    return e.ids, ids_b, groups, links


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def test_words_of_b_encode_as_whole_texts(libraries):
    own = align.Pieces(bpe.vocab_path(align.B))
    assert own.by_word
    rng = np.random.default_rng(1)
    letters = list("aAbé漢 \n  \t.,1'▁<0x41>") + [" the", "ing", "  ", "\U0001F600"]
    texts = [t or "" for _, t, *_ in ROWS] + ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    flat, n = own.encode_array(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [libraries[1].encode(t) for t in texts]


@pytest.mark.parametrize("chars,shown", [(align.BLOCK_CHARS, align.SHOWN), (200, 7)])
def test_equals_plain(spark, libraries, monkeypatch, tmp_path, chars, shown):
    monkeypatch.setattr(align, "BLOCK_CHARS", chars)
    monkeypatch.setattr(align, "SHOWN", shown)
    one = align.loaded(align.A, align.B)
    found = [plain(libraries, t) for _, t, *_ in ROWS]
    held = Counter(p for *_, links in found for p in set(links))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    want = [(d, len(a), len(b), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links)) for (d, *_), (a, b, _, links) in zip(ROWS, found, strict=True)]
    # the blocks of one process, then all of it on Spark
    x = one.align(pa.array([t or "" for _, t, *_ in ROWS]))
    assert [hashlib.sha256(written(g).encode()).hexdigest() if a else "" for a, _, g, _ in found if g is not None] == [s for s, (*_, g, _) in zip(x.shown(), found, strict=True) if g is not None]
    clash = {c: F.lit(1) for c in ("block", "pair", "n", "best", "i", "t", "place", "links", "n_a")}
    docs = spark.createDataFrame(ROWS, DDL).withColumns(clash)
    got = align.link_summary(docs).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_links, r.n_best, r.count_sum) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.groups_sha256) for r in got) == Counter((d, s) for (d, *_), s in zip(ROWS, x.shown(), strict=True))
    groups = {(r.doc_id, r.text): [(g.a, g.b) for g in r.groups] for r in align.align(docs).collect()}
    for (d, t, *_), (*_, g, _) in zip(ROWS, found, strict=True):
        assert g is None or groups[d, t] == g
    assert Counter((r.doc_id, r.n_groups) for r in got) == Counter((d, len(groups[d, t])) for d, t, *_ in ROWS)


def test_no_rows(spark):
    none = spark.createDataFrame([], DDL)
    assert align.link_summary(none).count() == 0 == align.align(none).count()


def test_op13(spark, libraries, tmp_path):
    rows = [r for r in ROWS if r[0] not in (10, 11)]
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter((d, len(a), len(b), len(g), len(links), hashlib.sha256(written(g).encode()).hexdigest() if a else "") for d, t, *_ in rows for a, b, g, links in [plain(libraries, t)] if g is not None)
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in llm.op13_alignment(spark, str(tmp_path)).collect())
    assert not want - got and sum(got.values()) == len(rows)
