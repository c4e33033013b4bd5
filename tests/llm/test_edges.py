"""Rows that differ in unusual columns alone, bounds that hold for null and repeated ids, and memory of products."""

import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import langid, mixing, near_dup, pii, quality, queries

from .test_operators import DDL, EDGE, text


def odd_rows(spark):
    """Two pairs of rows that differ in a map, or in a variant inside a struct, and one pair that differs in nothing."""
    rows = [(1, text(1, 80), 0, 5), (1, text(1, 80), 1, 5), (2, text(2, 80), 2, 6), (2, text(2, 80), 2, 7), (3, text(3, 80), 3, 8), (3, text(3, 80), 3, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, a int, b int").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.select("doc_id", "text", "lang", "source", "n_chars", F.create_map(F.lit("k"), "a").alias("m"), F.struct(F.create_map(F.lit(1), "a").alias("x"), F.parse_json(F.col("b").cast("string")).alias("v")).alias("st"))


def shown(df):
    return Counter((r.doc_id, r.m["k"], str(r.st.v)) for r in df.collect())


def test_rows_that_differ_in_a_map_or_variant(spark):
    docs = odd_rows(spark)
    assert quality.judge(docs).count() == 6
    assert shown(quality.keep_good(docs)) == shown(docs)
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    # the mix takes a document, none, once or twice; each row stands for itself
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    got = shown(mixed)
    assert set(got) <= set(shown(docs)) and all(n <= 2 * shown(docs)[k] for k, n in got.items()) and len(got) >= 4


def test_pipeline_of_edge_rows(spark, tmp_path):
    """run() is its stages one after another; the encoded texts are those that the mix kept."""
    long = [(500 + i, text(100 + i, 60), ("en", "de")[i % 2], ("a", "b", None)[i % 3], 9) for i in range(40)]
    rows = [*EDGE, *long, long[0], (None, long[1][1], "en", "a", 9), (None, None, None, None, None), (700, long[2][1] + " mail me: ann@example.com", "de", "c", 9)]
    spark.createDataFrame(rows, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    ids = Counter(r.doc_id for r in got.collect())
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert max(ids.values()) <= 2 + (None in ids) and 2 not in ids and 3 not in ids and {4, 5} & set(ids) == set()
    assert len(set(ids)) >= 20 and not (500 in ids and ids[500] > 2)
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_language_sample_is_bounded(spark):
    """A document counts once, whatever its id and however many copies it has."""
    rows = [(None, f"text number {i}", "en") for i in range(50)] + [(None, "copied text", "en")] * 30 + [(7, f"seven {i}", "de") for i in range(20)] + [(8, None, "de"), (9, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.sample(docs, 5).collect()
    assert Counter(r.lang for r in found) == Counter({"en": 5, "de": 5}) and len({(r.lang, r.text) for r in found}) == 10
    every = langid.sample(docs, 1000).collect()
    assert Counter((r.lang, r.text) for r in every) == Counter({(lang, t) for _, t, lang in rows if t and lang})


def test_context_words_are_whole():
    run = "a1B2c3D4e5F6g7H8i9J0k1"
    assert [s[0] for s in pii.spans_of(f"key {run}")] == ["secret"]
    for lead in ("monkey", "xkey", "key_"):  # no context word, wherever the window begins
        for pad in range(50, 64):
            assert pii.spans_of(f"{lead} {'.' * pad} {run}") == []
    far = lambda n: pii.spans_of(f"{run}{' ' * n}key")
    assert far(pii.CONTEXT_CHARS - 3) and not far(pii.CONTEXT_CHARS - 2)
    assert pii.spans_of(f"{run} {'.' * (pii.CONTEXT_CHARS - 4)}keys") == []
    assert [s[:3] for s in pii.spans_of("token " + run * 300)] == [("secret", 6, 6 + 22 * 300)]


def test_a_product_of_long_sets_stays_small():
    """As many near copies of 19,800 shingles as one product takes."""
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 19_800, dtype=np.uint64))
    n = int(near_dup.TILE_SHINGLES / len(base))
    sets = [np.unique(np.r_[base[rng.random(len(base)) > 0.02], rng.integers(0, 2**63, 300, dtype=np.uint64)]) for _ in range(n)]
    tracemalloc.start()
    labels, found = near_dup.multiply(sets, None, np.ones(n, np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6 and set(labels.tolist()) == {0} and (found == n - 1).all()


def test_long_sets_over_many_tiles(spark, monkeypatch):
    from .test_operators import brute_components, brute_links

    monkeypatch.setattr(near_dup, "TILE_SHINGLES", 2000)
    words = text(4, 400).split()
    rows = [(i, " ".join([*words[:7 * i], f"x{i}", *words[7 * i:]])) for i in range(25)] + [(100 + i, text(50 + i, 90)) for i in range(30)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == brute_links(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows)


def test_op4_shows_the_posterior(spark, tmp_path):
    pages = [(i, f"https://{h}.example.de/{i}") for i, h in enumerate(["good"] * 60 + ["bad"] * 60)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, 0 if i >= 60 else 1, 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.host: r for r in queries.op4_url_reputation(spark, str(tmp_path)).collect()}
    good, bad = got["good.example.de"], got["bad.example.de"]
    assert bad.bad_mean > 0.9 > 0.1 > good.bad_mean and bad.bad_bound < bad.bad_mean and bad.domain_mean == good.domain_mean
