"""Decontamination against a plain search of every window at every place."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairn.llm import decontam
from cairn.llm import queries as llm

from ..conftest import rows_of
from .test_operators import DDL, EDGE, SF, text

ITEMS = [(0, text(1, 30)), (1, text(1, 60)), (2, None), (3, " .,;"), (4, "Two words"), (5, "one"), (6, "zero zero zero zero zero zero zero zero zero zero zero zero"), (7, "Ünï-cödé 漢字 it's"),
         (8, text(3, 20000).split(" ", 4000)[-1][:700]), (8, "another text of one id, with ten words or more in it"), (None, "words of an item without any id, which are ten or more"), (10, text(1, 60)), (11, "never seen at all, in no text of this corpus, nor in part")]
ROWS = [*EDGE, (40, "zero " * 25 + "one " + "zero " * 9, "en", "a", 1), (41, "x " + text(1, 30) + "! " + text(1, 30).upper() + " y", "en", "a", 1), (42, "see: TWO-WORDS, it's", "en", "a", 1), (43, " ".join(text(1, 60).split()[20:29]), "en", "a", 1),
        (44, "an item without any id, words of an item without any id, which are ten or more", "en", "a", 1), (45, "ÜNÏ cödé 漢字 it s ünï cödé 漢字 it s Ünï-cödé", "fr", "b", 1), (46, "Another text of one id with ten words or more in itself", "en", "a", 1)]


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(rows, items, window=10, size=5, share=1.0):
    held = {}
    for item, t in items:
        w = split(t)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            held.setdefault(tuple(w[i:i + k]), set()).add(item)
    for d, t, *_ in rows:
        w, hit, named = split(t), set(), set()
        for i in range(len(w)):
            for k in {len(x) for x in held} if share == 1 else ():
                for item in held.get(tuple(w[i:i + k]), ()) if i + k <= len(w) else ():
                    hit |= set(range(i, i + k))
                    named |= {str(item)} - {"None"}
            for x, of in held.items() if share < 1 else ():
                s = min(size, len(x))
                m = len(x) - s + 1
                if i + len(x) <= len(w) and sum(w[i + j:i + j + s] == list(x[j:j + s]) for j in range(m)) >= share * m:
                    hit |= set(range(i, i + len(x)))
                    named |= {str(q) for q in of} - {"None"}
        spans = [(a, b) for a in sorted(hit) if a - 1 not in hit for b in [next(b for b in range(a + 1, len(w) + 1) if b not in hit)]]
        yield d, len(w), len(hit), tuple(spans), tuple(sorted(named))


def found(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(tuple(s) for s in r.spans), tuple(r.items)) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    clash = ("row", "n", "block", "at", "words", "p", "h", "key", "k", "item", "w")
    return tuple(df.withColumns({c: F.lit(1) for c in clash}) for df in (spark.createDataFrame(ROWS, DDL), spark.createDataFrame(ITEMS, "item_id long, text string")))


@pytest.mark.parametrize("block,bound", [(decontam.BLOCK, decontam.BROADCAST_BYTES), (7, decontam.BROADCAST_BYTES), (4096, 20000)])
def test_equals_plain(tables, monkeypatch, block, bound):
    monkeypatch.setattr(decontam, "BLOCK", block)
    assert found(decontam.contamination(*tables, bound=bound)) == Counter(plain(ROWS, ITEMS))


def test_share_below_one(spark, tables, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 50)
    rows = [r for r in ROWS if r[0] != 10] + [(50, "x " + text(1, 9) + " CHANGED " + " ".join(text(1, 60).split()[10:40]), "en", "a", 1)]
    docs = spark.createDataFrame(rows, DDL)
    assert found(decontam.contamination(docs, tables[1], size=3, share=0.5)) == Counter(plain(rows, ITEMS, size=3, share=0.5))


def test_no_rows(tables):
    docs, items = tables
    assert decontam.contamination(docs.limit(0), items).count() == 0
    assert found(decontam.contamination(docs, items.limit(0))) == Counter((d, len(split(t)), 0, (), ()) for d, t, *_ in ROWS)


def test_no_python_and_no_shuffle_of_positions(spark, tables):
    blocks = decontam.word_blocks(tables[0])
    plan = decontam._joined(decontam._shingles(blocks, 5), decontam.item_windows(tables[1]).select(F.col("hs")[0].alias("h"), "key"), "h", decontam.BROADCAST_BYTES)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan


def test_op12(spark, duck):
    assert rows_of(llm.op12_decontaminate(spark, SF).toPandas()) == rows_of(duck.execute(llm.ORACLE_SQL["op12_decontaminate"]).fetchdf())
