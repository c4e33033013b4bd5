"""Quality rules: whole-text statistics, then robust multivariate outliers.

Each (lang, source) gets a minimum-covariance-determinant estimate of location and
scatter of its documents' statistic vectors: four starts (medians and MADs, classical
moments, spatial signs, tanh scores) take TRIAL concentration steps each - distances of
all rows, the closest half by a quantile that is right to a thousandth of the rows, their
moments -, the one of least determinant takes the rest of STEPS. Rows inside the 0.975
quantile of the corrected distances give the reweighted estimate. All steps are grouped
aggregates over every row of a small staged table (no text), so a group with a third
of all rows is summed map-side like any other.

Estimates are shrunk: a group's to the pooled one of all groups as if that stood for
PRIOR_ROWS more documents, the pooled one in the same way to a broad fixed prior. So a
group of one document, or a table of three, is judged by the same formula as a large one.
A document is rejected if its squared Mahalanobis distance is beyond the chi-squared
quantile of upper tail TAIL and the statistic that adds most to it points the bad way.

Edge cases: null text has no words and fails the base rule. Null lang or source form
groups of their own. Scatter is floored, so constant statistics and groups of equal rows
have finite distances. Repeated rows count as often as they stand. An empty table, or one
in which every document fails the base rule, gives no estimate and no distance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .env import free, row_key, ship, staged

WINDOW = 8
SYMBOLS = "#*$%&|<>"
STEPS, TRIAL = 6, 2  # concentration steps in all, and of every start
PRIOR_ROWS = 50.0  # documents that the parent estimate stands for
BROADCAST_ROWS = 1_000_000  # rejected rows that may be broadcast; beyond, the join shuffles
TAIL = 1e-10  # upper tail of chi-squared beyond which a document goes: far out, as clean text has heavier tails than a normal
#: Least standard deviation of each statistic below.
FLOOR = {"v_len": 0.05, "v_sym": 0.03, "v_dup": 0.1, "v_rep": 0.1, "v_up": 0.03, "v_punct": 0.03, "v_adj": 0.06}
STATS = tuple(FLOOR)
#: Standard deviations of the broad prior, which tables of few documents lean on.
PRIOR_SD = {"v_len": 0.5, "v_sym": 0.15, "v_dup": 0.4, "v_rep": 0.4, "v_up": 0.25, "v_punct": 0.2, "v_adj": 0.3}

STATS_DDL = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_upper:bigint,n_punct:bigint,n_adjacent:bigint>"

_P = np.uint64(0x9E3779B97F4A7C15)


def repeat_words(words: list[bytes]) -> int:
    """Words inside WINDOW-word windows that occur twice or more, each word once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    w = (w + np.uint64(1)) * _P
    w ^= w >> np.uint64(29)
    w *= np.uint64(0xBF58476D1CE4E5B9)
    w ^= w >> np.uint64(32)
    h = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        h = h * np.uint64(0x94D049BB133111EB) + w[i:i + n]
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = np.zeros(n, bool)
    eq = s[1:] == s[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    if not same.any():
        return 0
    starts = order[same]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


_SPACE_BYTES = b" \t\n\v\f\r"


def stats_of(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * 8
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    spaces = int(counts[list(_SPACE_BYTES)].sum())
    dup = 0
    if b"\n" in raw:
        lines = [x for x in raw.split(b"\n") if x.strip()]
        dup = len(lines) - len(set(lines))
    upper = int(counts[65:91].sum())
    punct = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    return len(words), len(text) - spaces, int(counts[list(SYMBOLS.encode())].sum()), dup, repeat_words(words), upper, punct, sum(a == b for a, b in zip(words, words[1:], strict=False))


def text_stats(texts: pa.Array) -> pa.Array:
    rows = np.array([stats_of(t.as_py()) for t in texts], np.int64).reshape(-1, 8)
    names = [x.split(":")[0] for x in STATS_DDL[7:-1].split(",")]
    return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(8)], names)


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vectors(df: DataFrame) -> DataFrame:
    w, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    root = lambda a, b: F.sqrt(F.least(a / b, F.lit(1.0)))
    return df.withColumns({
        "v_len": F.log(c / w),
        "v_sym": root(F.col("n_symbols"), c),
        "v_dup": F.log1p(F.col("n_dup_lines").cast("double")) / 4,
        "v_rep": root(F.col("n_repeat_words"), w),
        "v_up": root(F.col("n_upper"), c),
        "v_punct": root(F.col("n_punct"), c),
        "v_adj": root(F.col("n_adjacent"), w),
    })


def chi2_tail(x: float, d: int) -> float:
    """Upper tail of chi-squared with an odd number of degrees."""
    total, term = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, d - 1, 2):
        total += term
        term *= x / (k + 2)
    return total


def chi2_quantile(tail: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_tail(mid, d) > tail else (lo, mid)
    return hi


D = len(STATS)
MEDIAN, INNER = chi2_quantile(0.5, D), chi2_quantile(0.025, D)
#: The scatter of normal data inside INNER is too small by this factor.
INNER_FACTOR = 0.975 / (1 - chi2_tail(INNER, D + 2))
CUT = chi2_quantile(TAIL, D)

_PAIRS = [(a, b) for i, a in enumerate(STATS) for b in STATS[i:]]
_MU, _S = [f"mu_{a}" for a in STATS], [f"s_{a}_{b}" for a, b in _PAIRS]
GROUP = ("g1", "g2")


def _on(a: str, b: str, key: tuple) -> list:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in key]


def _moments(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(a).alias(m) for a, m in zip(STATS, _MU, strict=True)], *[F.covar_pop(a, b).alias(s) for (a, b), s in zip(_PAIRS, _S, strict=True)])


def _estimates(moments: DataFrame) -> DataFrame:
    """Adds loc and inv (row-wise inverse of the floored scatter), both array<double>, and logdet of the floored scatter."""
    floor = np.diag([FLOOR[a] ** 2 for a in STATS])

    @F.arrow_udf("struct<loc:array<double>,inv:array<double>,logdet:double>")
    def invert(*cols: pa.Array) -> pa.Array:
        locs, invs, dets = [], [], []
        for row in zip(*(c.to_pylist() for c in cols), strict=True):
            s = np.zeros((D, D))
            s[np.triu_indices(D)] = row[D:]
            s = s + np.triu(s, 1).T + floor
            locs.append(list(row[:D]))
            invs.append(np.linalg.inv(s).ravel().tolist())
            dets.append(float(np.linalg.slogdet(s)[1]))
        return pa.StructArray.from_arrays([pa.array(locs, pa.list_(pa.float64())), pa.array(invs, pa.list_(pa.float64())), pa.array(dets, pa.float64())], ["loc", "inv", "logdet"])

    return moments.withColumn("e", invert(*_MU, *_S)).select(*moments.columns, "e.loc", "e.inv", "e.logdet")


def _off(i: int) -> F.Column:
    return F.col(STATS[i]) - F.get(F.col("loc"), F.lit(i))


def _distance() -> F.Column:
    """Squared distance of the vector columns under loc and inv; no array is built per row."""
    u, total = [_off(i) for i in range(D)], F.lit(0.0)
    for i in range(D):
        for j in range(i, D):
            total = total + (1.0 if i == j else 2.0) * u[i] * u[j] * F.get(F.col("inv"), F.lit(i * D + j))
    return total


def _points_bad() -> F.Column:
    """Whether the statistic that adds most to the distance lies above its centre; for v_len either way is bad."""
    u = [_off(i) for i in range(D)]
    part = lambda i: u[i] * sum((u[j] * F.get(F.col("inv"), F.lit(i * D + j)) for j in range(D)), F.lit(0.0))
    return F.array_max(F.array(*[F.struct(part(i).alias("x"), (F.lit(a == "v_len") | (u[i] > 0)).alias("bad")) for i, a in enumerate(STATS)]))["bad"]


def _scored(rows: DataFrame, now: DataFrame) -> DataFrame:
    extra = [c for c in ("start", "half") if c in now.columns]
    return rows.alias("r").join(now.alias("e"), _on("r", "e", GROUP)).select("r.*", "e.loc", "e.inv", *[f"e.{c}" for c in extra]).withColumn("d2", _distance())


def _half(scored: DataFrame, *key: str) -> DataFrame:
    return scored.groupBy(*key).agg(F.percentile_approx("d2", 0.5, 1000).alias("half"))


def _concentrate(rows: DataFrame, now: DataFrame) -> DataFrame:
    """One step of every (group, start): the estimate from the half that is nearest under the one before."""
    key = (*GROUP, "start")
    scored = _scored(rows, now)
    core = scored.alias("r").join(_half(scored, *key).alias("h"), _on("r", "h", key)).filter("r.d2 <= h.half").select("r.*")
    return staged(_estimates(_moments(core, *key)), "quality-estimate")


def _starts(rows: DataFrame) -> DataFrame:
    """(g1, g2, start, moments): only the shape of a start's scatter counts, as the nearest half does not change with its scale."""
    mids = rows.groupBy(*GROUP).agg(*[F.percentile_approx(a, 0.5, 1000).alias(f"q_{a}") for a in STATS])
    near = rows.alias("r").join(mids.alias("m"), _on("r", "m", GROUP)).select("r.*", *[f"m.q_{a}" for a in STATS])
    mads = near.groupBy(*GROUP).agg(*[F.first(f"q_{a}").alias(f"q_{a}") for a in STATS], *[F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(a) - F.col(f"q_{a}")), 0.5, 1000), F.lit(FLOOR[a])).alias(f"w_{a}") for a in STATS])
    mads = staged(mads, "quality-spreads")
    z = rows.alias("r").join(mads.alias("m"), _on("r", "m", GROUP)).select("r.*", *[((F.col(f"r.{a}") - F.col(f"q_{a}")) / F.col(f"w_{a}")).alias(f"z_{a}") for a in STATS])
    z = z.withColumn("len", F.greatest(F.sqrt(sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in STATS), F.lit(0.0))), F.lit(1e-9)))
    z = z.withColumns({f"t_{a}": F.tanh(f"z_{a}") for a in STATS} | {f"u_{a}": F.col(f"z_{a}") / F.col("len") for a in STATS})
    second = [F.avg(F.col(f"{k}_{a}") * F.col(f"{k}_{b}")).alias(f"{k}_{a}_{b}") for k in "tu" for a, b in _PAIRS]
    plain = [F.avg(a).alias(m) for a, m in zip(STATS, _MU, strict=True)] + [F.covar_pop(a, b).alias(s) for (a, b), s in zip(_PAIRS, _S, strict=True)]
    sums = z.groupBy(*GROUP).agg(*plain, *second).alias("s").join(mads.alias("m"), _on("s", "m", GROUP))
    centre = [F.col(f"q_{a}").alias(m) for a, m in zip(STATS, _MU, strict=True)]
    scaled = lambda k: [(F.col(f"{k}_{a}_{b}") * F.col(f"w_{a}") * F.col(f"w_{b}")).alias(s) for (a, b), s in zip(_PAIRS, _S, strict=True)]
    diagonal = [(F.col(f"w_{a}") * F.col(f"w_{b}") if a == b else F.lit(0.0)).alias(s) for (a, b), s in zip(_PAIRS, _S, strict=True)]
    every = [[*centre, *diagonal], [*_MU, *_S], [*centre, *scaled("u")], [*centre, *scaled("t")]]
    return sums.select("s.g1", "s.g2", F.posexplode(F.array(*[F.struct(*x) for x in every])).alias("start", "x")).select(*GROUP, "start", "x.*")


def _shrunk(own: DataFrame) -> DataFrame:
    """own (g1, g2, n, moments of each group) with group and pooled moments mixed by numbers of documents."""
    mean = lambda c: F.sum(F.col("n") * c) / F.sum("n")
    pool = own.agg(F.sum("n").alias("n"), *[mean(F.col(m)).alias(m) for m in _MU], *[mean(F.col(s) + F.col(f"mu_{a}") * F.col(f"mu_{b}")).alias(s) for (a, b), s in zip(_PAIRS, _S, strict=True)]).first()
    if not pool.n:
        return own
    part = pool.n / (pool.n + PRIOR_ROWS)
    base = {s: part * (pool[s] - pool[f"mu_{a}"] * pool[f"mu_{b}"]) + ((1 - part) * PRIOR_SD[a] ** 2 if a == b else 0.0) for (a, b), s in zip(_PAIRS, _S, strict=True)} | {m: pool[m] for m in _MU}
    w = F.col("n") / (F.col("n") + PRIOR_ROWS)
    return own.select(*GROUP, *[(w * F.col(c) + (1 - w) * F.lit(base[c])).alias(c) for c in (*_MU, *_S)])


def outliers(stats: DataFrame) -> DataFrame:
    """stats (_row, lang, source, counts) to (_row, distance), 0 where it points no bad way, of the rows that pass the base rule."""
    rows = staged(_vectors(stats.filter(~base_failed())).select("_row", F.col("lang").alias("g1"), F.col("source").alias("g2"), *STATS), "quality-vectors")
    now = staged(_estimates(_starts(rows)), "quality-estimate")
    for _ in range(TRIAL):
        now = _concentrate(rows, now)
    fields = [c for c in now.columns if c not in GROUP]
    best = now.groupBy(*GROUP).agg(F.min_by(F.struct(*fields), F.struct("logdet", "start")).alias("b"))
    now = staged(best.select(*GROUP, *[F.col(f"b.{c}").alias(c) for c in fields]), "quality-estimate")
    for _ in range(STEPS - TRIAL):
        now = _concentrate(rows, now)
    scored = _scored(rows, now)
    now = staged(now.alias("e").join(_half(scored, *GROUP).alias("h"), _on("e", "h", GROUP)).select("e.*", "h.half"), "quality-estimate")
    inner = _scored(rows, now).filter(F.col("d2") * MEDIAN <= INNER * F.greatest("half", F.lit(1e-9)))
    sizes = rows.groupBy(*GROUP).agg(F.count("*").alias("n"))
    own = sizes.alias("n").join(_moments(inner, *GROUP).alias("m"), _on("n", "m", GROUP)).select("n.g1", "n.g2", "n.n", *[f"m.{m}" for m in _MU], *[(F.col(f"m.{s}") * INNER_FACTOR).alias(s) for s in _S])
    final = staged(_estimates(_shrunk(staged(own, "quality-estimate"))), "quality-estimate")
    return _scored(rows, final).select("_row", F.when(_points_bad(), F.col("d2")).otherwise(0.0).alias("distance"))


def judge(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, distance (null if base_failed or no estimate), kept."""
    return _verdicts(docs, cut).drop("_row", "_of", "lang", "source")


def keep_good(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of docs that are kept, with their columns. Only the keys of rejected rows
    are joined, broadcast while few; a key is of the whole row, so no other row goes with it."""
    no, of, key = free(docs, "_bad", "_bad_of", "_row_key")
    bad = staged(_verdicts(docs, cut).filter(~F.col("kept")).select("doc_id", "_of").distinct(), "rejected").toDF(no, of)
    small = bad.count() <= BROADCAST_ROWS
    keyed = docs.withColumn(key, row_key(docs))
    return keyed.join(F.broadcast(bad) if small else bad, F.col("doc_id").eqNullSafe(F.col(no)) & (F.col(key) == F.col(of)), "left_anti").drop(key)


def _verdicts(docs: DataFrame, cut: float) -> DataFrame:
    stats, far = _judged(docs)
    out = stats.alias("a").join(far.alias("b"), F.col("a._row") == F.col("b._row"), "left")
    return out.select("a.*", "b.distance", (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)).alias("kept"))


def _judged(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    ship(docs.sparkSession)
    stats = docs.select("doc_id", "lang", "source", row_key(docs).alias("_of"), F.arrow_udf(text_stats, STATS_DDL)("text").alias("s")).select(F.monotonically_increasing_id().alias("_row"), "_of", "doc_id", "lang", "source", "s.*")
    stats = staged(stats, "quality-stats").withColumn("base_failed", base_failed())
    return stats, outliers(stats)
