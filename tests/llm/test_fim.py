"""Fill-in-middle against a plain version, with chunks short enough that most texts are dealt out."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import fim
from cairn.llm import queries as llm

from ..conftest import rows_of
from .test_operators import DDL, EDGE, SF

LINES = "".join(f"line {i} über\n" * (i % 3 + 1) + "\n" * (i % 4) for i in range(300))
ROWS = [*EDGE, (30, "no break", "en", "a", 1), (31, "\n", "en", "a", 1), (32, "\n\n\na\n", "en", "a", 1), (33, LINES, "en", "a", 1), (33, LINES, "en", "a", 1), (34, LINES + "漢字 end", "en", "b", 1), (35, LINES + "<S>", "en", "b", 1),
        (36, "a <P\n> b\n<", "en", "b", 1), (37, "x" * 700 + "\n" + "y" * 255 + "\n" + "\U0001F600" * 300, "en", "b", 1), (38, "> c\n<M", "en", "b", 1), (None, LINES, "en", "a", 1)]
PATTERN = {"line": r"[^\n]*\n|[^\n]+", "word": r"(?s)\A[ \t-\r]*[^ \t-\r]+[ \t-\r]*|[^ \t-\r]+[ \t-\r]*"}


def plain(doc_id, t, unit="line", seed=7, rate=100, spm=50):
    t = t or ""
    units = re.findall(PATTERN[unit], t)
    n, digest = len(units), hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    cut = lambda k: len(t) if k == n and k else len("".join(units[:k]))
    p, m, s = t[:cut(lo)], t[cut(lo):cut(hi)], t[cut(hi):]
    if not t or any(x in t for x in fim.MARKERS) or h[2] % 100 >= rate:
        return n, "plain", None, None, t
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DDL)
    return df.withColumns({c: F.lit(1) for c in ("n", "_cut", "_digest", "digest", "place", "at", "_at", "_n", "_k1", "_scan", "form")})


@pytest.mark.parametrize("unit,chunk,seed,rate", [("line", fim.CHUNK, 7, 100), ("line", 1000, 7, 100), ("line", 37, 1, 60), ("word", 50, 3, 100), ("word", fim.CHUNK, 3, 100)])
def test_equals_plain(docs, unit, chunk, seed, rate):
    made = fim.transform(docs, unit=unit, chunk=chunk, seed=seed, rate=rate)
    assert made.columns == [*docs.columns, "fim"]
    got = made.select("doc_id", "text", "fim.*", fim.restore(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in got)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter((d, *plain(d, t, unit, seed, rate)) for d, t, *_ in ROWS)


def test_no_rows(docs):
    assert fim.transform(docs.limit(0)).count() == 0 == fim.transform(docs.limit(0), chunk=1).count()


def test_composition_is_that_of_one_scan():
    rng = np.random.default_rng(5)
    own = fim.UNITS["line"]
    for n in (0, 1, 255, 256, 257, 5000):
        data = rng.choice(np.frombuffer(b"ab\n ", np.uint8), n)
        scan = own.scan(data, np.array([0, n]))
        for state in (0, 1):
            s, starts = state, []
            for i, b in enumerate(data):
                starts += [i] * (s == 0)
                s = 0 if b == 10 else 1
            assert (scan.end[state, 0], scan.total[state, 0]) == (s, len(starts))
            for k in {0, len(starts) // 2, len(starts)}:
                assert scan.select(np.array([state]), np.array([k]))[0] == [*starts, n][k]


def test_op11(spark, duck):
    assert rows_of(llm.op11_fill_in_middle(spark, SF).toPandas()) == rows_of(duck.execute(llm.ORACLE_SQL["op11_fill_in_middle"]).fetchdf())
