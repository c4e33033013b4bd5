"""Effects at all levels, sketches, the QR fit, JSON columns, SQL functions, partitioned sinks, summaries and searches."""

import json
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cairn.functions import props
from cairn.operators import counted, cube, linear, metrics, sampling, sketches, tuning
from cairn.operators.features import feature_pipeline, fit_pipeline
from cairn.plans import sql as front
from cairn.sources import readers, sinks
from cairn.sources.fixtures import CATALOG, calendar, conversions

SF = "/root/testdata/sf0.001"


# ---- effects at all levels ----

def test_effects_of_every_set(spark):
    rng = np.random.default_rng(1)
    rows = [(str(a) if a else None, int(b), float(v) if v > -1.5 else None, float(t)) for a, b, v, t in zip(rng.choice(["", "x", "y"], 400), rng.integers(0, 3, 400), rng.normal(0.3, 1, 400), rng.integers(0, 2, 400), strict=True)]
    df = spark.createDataFrame(rows, "a string, b int, ada_dre double, is_treated_by_ada double")
    got = {(r.a, r.b, r.level, r.estimand): r for r in cube.effects_by(df, ["ada"], ["a", "b"]).collect()}
    want = defaultdict(list)
    for a, b, v, t in rows:
        for level, key in ((0, (a, b)), (1, (a, None)), (2, (None, b)), (3, (None, None))):
            for e in ("ATE", "ATT"):
                if v is not None and (e == "ATE" or t):
                    want[*key, level, e].append(v)
    assert set(got) == set(want)
    for k, v in want.items():
        half = 1.96 * np.std(v, ddof=1) / math.sqrt(len(v))
        assert (got[k].n, got[k].estimate, got[k].ci_lo, got[k].ci_hi) == (len(v), pytest.approx(np.mean(v)), pytest.approx(np.mean(v) - half), pytest.approx(np.mean(v) + half))
    rolled = cube.effects_by(df, ["ada"], ["a", "b"], cube.rollup_sets(["a", "b"]))
    assert {r.level for r in rolled.select("level").distinct().collect()} == {0, 1, 3}
    assert cube.effects_by(df.limit(0), ["ada"], ["a", "b"]).count() == 0


def test_rows_are_reduced_before_they_are_expanded(spark):
    df = spark.createDataFrame([("x", 1, 0.5, 1.0)], "a string, b int, ada_dre double, is_treated_by_ada double")
    plan = cube.effects_by(df, ["ada"], ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("Generate")  # the plan's top is its end


# ---- sketches ----

def test_sketches_merge_within_their_error(spark):
    n = 40_000
    df = spark.range(n).select((F.col("id") % 5).alias("day"), F.xxhash64(F.col("id") % 30_000).alias("who"), (F.hash("id") / 1e9).alias("v"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("arm"))
    stored = sketches.reach(df, ["arm", "day"], "who").join(sketches.spread(df, ["arm", "day"], "v"), ["arm", "day"])
    by_arm = sketches.merged(stored, ["arm"])
    exact = {r.arm: r.n for r in df.groupBy("arm").agg(F.countDistinct("who").alias("n")).collect()}
    for r in by_arm.select("arm", sketches.size(F.col("reach")).alias("n"), sketches.quantile(F.col("spread"), 0.25).alias("q")).collect():
        assert abs(r.n - exact[r.arm]) <= sketches.relative_error() * exact[r.arm]
        below = df.filter((F.col("arm") == r.arm) & (F.col("v") <= r.q)).count() / df.filter(F.col("arm") == r.arm).count()
        assert abs(below - 0.25) <= sketches.rank_error()
    pair = sketches.overlaps(by_arm, "arm").first()
    shared = df.filter("arm = 'even'").select("who").intersect(df.filter("arm = 'odd'").select("who")).count()
    assert (pair.a, pair.b) == ("even", "odd") and abs(pair.n_both - shared) <= sketches.relative_error() * pair.n_either


def test_sketches_of_few_are_exact_and_ignore_nulls(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, None), ("a", None, 4.0), ("b", 2, 1.0), ("b", 1, 1.0)], "arm string, who int, v double")
    assert {(r.arm, r.n) for r in sketches.reach(df, ["arm"], "who").select("arm", sketches.size(F.col("reach")).alias("n")).collect()} == {("a", 1), ("b", 2)}
    assert sketches.merged(sketches.spread(df, ["arm"], "v"), []).select(sketches.quantile(F.col("spread"), 1.0).alias("q")).first().q == 4.0


# ---- QR ----

def stiff(n=4000, k=6, condition=1e8, seed=2):
    """Rows whose design, columns scaled, has that condition number; the answer is known up to rounding."""
    rng = np.random.default_rng(seed)
    u, _ = np.linalg.qr(rng.normal(size=(n, k)))
    v, _ = np.linalg.qr(rng.normal(size=(k, k)))
    x = u * np.geomspace(1, 1 / condition, k) @ v
    b = rng.normal(size=k)
    return x, rng.uniform(0.5, 2, n), x @ b, b


def test_qr_keeps_what_normal_equations_lose(spark):
    x, w, y, b = stiff()
    df = spark.createDataFrame([(r.tolist(), float(a), float(c)) for r, a, c in zip(x, w, y, strict=True)], "x array<double>, w double, y double").repartition(7)
    r = linear.qr_factor(df, F.col("x"), F.col("w"), F.col("y"), 6)
    assert np.allclose(np.abs(r), np.abs(np.linalg.qr(np.c_[x, y] * np.sqrt(w)[:, None], "r")), atol=1e-9)
    found = linear.solve_qr(r, 2)
    assert np.abs(x @ (found["b"] - b)).max() <= 1e-8 * np.abs(y).max() and np.abs(found["b"] - b).max() <= 1e-6
    gram, moment = linear.normal_equations(df, F.col("x"), F.col("w"), F.col("y"), 6)
    assert np.abs(linear.solve(gram, moment, None, 2)["b"] - b).max() > 1e-2
    e = (y - x @ found["b0"]) * w
    assert np.abs(x[:, :4].T @ e).max() <= 1e-8 * np.linalg.norm(e) and (found["b0"][4:] == 0).all()


def test_qr_of_collinear_columns_is_the_least_norm_fit(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3))
    x = np.c_[x, x[:, 0] + x[:, 1], np.zeros(500)]
    y, w = rng.normal(size=500), rng.uniform(0, 1, 500)
    rows = [(r.tolist(), float(a), float(c)) for r, a, c in zip(x, w, y, strict=True)] + [(None, 1.0, 1.0), ([1.0] * 5, None, 1.0), ([1.0] * 4, 1.0, 1.0), ([1.0, 2.0, None, 4.0, 5.0], 1.0, 1.0)]
    df = spark.createDataFrame(rows, "x array<double>, w double, y double")
    found = linear.solve_qr(linear.qr_factor(df, F.col("x"), F.col("w"), F.col("y"), 5), 0)
    s = np.sqrt(w)[:, None]
    assert np.allclose(found["b"], np.linalg.lstsq(x * s, y * s[:, 0], rcond=1e-10)[0]) and np.allclose(found["A"], np.linalg.pinv((x * s).T @ (x * s), rcond=1e-10))
    none = linear.solve_qr(linear.qr_factor(df.limit(0), F.col("x"), F.col("w"), F.col("y"), 5), 2)
    assert (none["b"] == 0).all() and (none["b0"] == 0).all()


def test_both_solvers_agree(spark):
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(800, 5)), rng.uniform(0.2, 1, 800)
    y = x @ [1, 2, 0, -1, 0.5] + rng.normal(size=800)
    from pyspark.ml.feature import VectorAssembler

    flat = spark.createDataFrame([(*map(float, r), float(a), float(c)) for r, a, c in zip(x, w, y, strict=True)], ", ".join(f"x{i} double" for i in range(5)) + ", purchase_weight double, conversionIndicator double")
    made = VectorAssembler(inputCols=[f"x{i}" for i in range(5)], outputCol="features").transform(flat)
    a, b = (linear.LiftRegression(solver=s).fit(made).state() for s in ("qr", "normal"))
    assert all(np.allclose(a[k], b[k]) for k in ("b", "b0", "cov", "V")) and a["names"] == b["names"]
    with pytest.raises(ValueError):
        linear.LiftRegression(solver="cg")


def test_pipeline_fitted_on_distinct_rows_is_the_same(spark):
    rows = readers.prepare_conversions(conversions(spark, SF), calendar(spark))
    for options in ({}, {"bucketize": True}, {"model_type": "dre", "propensity_model": "RandomForest"}):
        stages = feature_pipeline(CATALOG, **options)
        a, b = (f.transform(rows).select("event_id", "features", "treatment_type_indexed") for f in (stages.fit(rows), fit_pipeline(stages, rows)))
        assert a.schema["features"].metadata == b.schema["features"].metadata
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


# ---- JSON ----

def test_props(spark):
    rows = [(1, '{"k": 1, "s": "x"}'), (2, '{"k": 2.5, "l": [1, 2]}'), (3, '{"k": 3'), (4, None), (5, "[1]"), (6, '{"k": null}'), (7, ""), (8, "{}"), (9, '{"k": "7"}')]
    df = spark.createDataFrame(rows, "id int, p string")
    good, bad = props.split_malformed(df, "p")
    assert {r.id for r in bad.collect()} == {3, 7} and good.count() == 7
    schema = props.json_schema(df.filter("id <> 5"), "p")
    assert set(schema.names) == {"k", "s", "l"}
    numbers = df.filter("id in (1, 2, 3, 4, 8)")
    got = {r.id: r.j for r in props.parsed(numbers, "p", "j").collect()}
    assert float(got[1].k) == 1 and float(got[2].k) == 2.5 and got[2].l == [1, 2] and got[1].s == "x" and got[3] is None and got[4] is None and got[8].k is None
    assert props.json_schema(df.filter("id = 4"), "p").names == []
    stats = {r.key: r for r in props.key_statistics(df, [], props.as_map(F.col("p"))).collect()}
    assert (stats["k"].n, stats["k"].n_numbers, stats["k"].total, stats["s"].n_numbers) == (4, 3, 10.5, 0)
    assert props.summed_maps(df.withColumn("g", F.lit(1)), ["g"], props.as_map(F.col("p"))).first().sums["k"] == 10.5


# ---- SQL ----

def test_sql_functions(spark):
    names = front.register_functions(spark)
    assert set(names) >= {"purchase_weight", "robust_lift", "aipw_factual", "exposure_arm"}
    got = spark.sql("""SELECT purchase_weight(4) AS a, purchase_weight(0) AS b, purchase_weight(NULL) AS c, robust_lift(0.5, 0.25) AS d, robust_lift(0, 1) AS e, robust_lift(NULL, 1) AS f, robust_lift(0.5, 1) AS g,
        aipw_factual(1, 1, 0, 0.5) AS h, exposure_arm(6, 0) AS i, exposure_arm(5, 6) AS j, exposure_arm(9, 9) AS k, exposure_arm(0, NULL) AS l""").first()
    assert tuple(got) == (0.25, 1.0, 1.0, 0.5, 0.0, None, 0.0, None, "ada", "aap", "both_impressions", "no_impression")
    plan = spark.sql("SELECT robust_lift(CAST(id AS DOUBLE), 1) FROM range(9)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- partitioned sinks ----

def test_one_day_is_written_again(spark, tmp_path):
    df = spark.range(300).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"), F.col("id").alias("v"))
    path = sinks.write_partitioned(df, f"{tmp_path}/out", ["day"], rows_per_file=40)
    files = lambda day: sorted(p.name for p in (tmp_path / "out" / f"day={day}").glob("*.parquet"))
    first, second = files("2024-01-01"), files("2024-01-02")
    assert len(first) >= 3  # 100 rows, at most 40 a file
    sinks.write_partitioned(df.filter("day = date '2024-01-02'").withColumn("v", -F.col("v")), path, ["day"])
    back = spark.read.parquet(path)
    assert files("2024-01-01") == first and files("2024-01-02") != second and back.count() == 300
    assert back.filter("v < 0").select("day").distinct().count() == 1
    sinks.write_partitioned(df.limit(0), path, ["day"])
    assert spark.read.parquet(path).count() == 300
    days = spark.range(30).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.col("id")).filter("id = 1")
    joined = back.join(days, F.col("day") == F.col("d"))
    joined.collect()
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()


# ---- summaries ----

def test_summary_is_the_same_beyond_one_task(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b) if b > 0 else None, None) for a, b in zip(rng.normal(size=3000).round(2), rng.normal(size=3000), strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    first = sorted(map(str, metrics.prediction_summary(df, ("a", "b", "c")).collect()))
    monkeypatch.setattr(sampling, "EXACT_ROWS", 100)
    assert sorted(map(str, metrics.prediction_summary(df, ("a", "b", "c")).collect())) == first and len(first) == 2
    assert metrics.prediction_summary(df.limit(0), ("a",)).count() == 0


def test_numbered_rows_need_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        master = "spark://host:7077"

    monkeypatch.setattr(type(spark), "sparkContext", property(lambda s: Elsewhere))
    monkeypatch.setattr(type(spark.conf), "get", lambda *a: None)
    with pytest.raises(ValueError), sampling.numbered(spark.range(3), "n"):
        pass


# ---- search ----

def test_halving_finds_what_the_full_search_finds(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    df = spark.createDataFrame([(i, Vectors.dense(r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))], ["id", "features", "label"])
    model = RandomForestClassifier(seed=1)
    grid = {"maxDepth": [1, 2, 4, 6], "numTrees": [3]}
    found = tuning.successive_halving(df, model, "label", F.col("id"), grid, folds=3, rungs=3)
    by_rung = Counter(r.rung for r in found.scores)
    assert by_rung == {0: 4, 1: 2, 2: 1} and [r.rows for r in found.scores] == sorted(r.rows for r in found.scores)
    assert found.best == {"maxDepth": 6, "numTrees": 3} and found.scores[-1].rows == 1500
    again = tuning.successive_halving(df.repartition(5), model, "label", F.col("id"), grid, folds=3, rungs=3)
    assert [(r.params, r.rows) for r in again.scores] == [(r.params, r.rows) for r in found.scores]
    assert json.dumps(found.best)
    with pytest.raises(ValueError):
        tuning.successive_halving(df, model, "label", F.col("id"), {"noSuch": [1]})


def _categories(spark, n=4000):
    """Rows of few kinds: two flags and a feature of five values, one of them of no use."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 2, n), rng.integers(0, 2, n), rng.integers(0, 5, n), rng.integers(0, 3, n)], 1).astype(float)
    y = (rng.random(n) < 0.15 + 0.5 * (x[:, 0] != x[:, 1]) + 0.06 * x[:, 2]).astype(float)
    return spark.createDataFrame([(i, Vectors.dense(r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))], ["id", "features", "label"])


def test_forest_on_counts_is_the_forest_on_rows(spark):
    df = _categories(spark).withColumns({"level": F.lit(0), "fold": F.when(F.col("id") < 500, 1).otherwise(0)})
    rows = counted.counted(df, RandomForestClassifier(), "level", 1, "fold", 2)
    assert rows.counts.sum() == 4000 and rows.counts[0, 1].sum() == 500 and rows.bins.shape == (60, 4)
    kinds = spark.createDataFrame([(Vectors.dense([float(v) for v in b]),) for b in rows.bins], ["features"])
    everything = rows.counts[0].sum(0)
    for depth, least in ((1, 1), (3, 40), (5, 5), (9, 1)):  # without chance: the same tree
        one = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=depth, minInstancesPerNode=least).fit(df)
        spark_votes = np.array([r.rawPrediction.toArray() for r in one.transform(kinds).collect()])
        assert np.allclose(counted.forest_votes(rows.bins, everything, 1, depth, least, 0.0, 1.0, False, "all", [1]), spark_votes, atol=1e-9)
    forest = RandomForestClassifier(numTrees=200, subsamplingRate=0.8, featureSubsetStrategy="sqrt", maxDepth=4, minInstancesPerNode=20, seed=3).fit(df)
    shares = np.array([r.probability[1] for r in forest.transform(kinds).collect()])
    ours = counted.forest_votes(rows.bins, everything, 200, 4, 20, 0.0, 0.8, True, "sqrt", [3])[:, 1] / 200
    assert np.abs(ours - shares).max() < 0.06 and abs((ours - shares).mean()) < 0.01 and np.corrcoef(ours, shares)[0, 1] > 0.99


def test_halving_over_categories_counts_rows_once(spark, monkeypatch):
    df = _categories(spark)
    grid = {"numTrees": [5, 20], "maxDepth": [2, 6]}
    search = lambda rows: tuning.successive_halving(rows, RandomForestClassifier(seed=1), "label", F.col("id"), grid, folds=3, rungs=2)
    found = search(df)
    assert search(df.repartition(7)).scores == found.scores  # counts don't depend on partitions, nor do metrics
    assert Counter(s.rung for s in found.scores) == {0: 4, 1: 2} and found.scores[-1].rows == 4000
    monkeypatch.setattr(tuning, "counted", lambda *_: None)
    plain = search(df)
    assert [(s.rung, s.rows) for s in plain.scores] == [(s.rung, s.rows) for s in found.scores]
    deep = [(a, b) for a, b in zip(plain.scores[:4], found.scores[:4], strict=True) if a.params["maxDepth"] == 6]  # five trees of depth 2 differ by 0.06 from seed to seed, Spark's as well
    assert len(deep) == 2 and all(a.params == b.params and abs(a.metric - b.metric) < 0.03 for a, b in deep)


def test_rows_that_counts_cannot_stand_for_are_left_to_spark(spark):
    df = _categories(spark).withColumns({"level": F.lit(0), "fold": F.col("id") % 2})
    ask = lambda rows, **options: counted.counted(rows, RandomForestClassifier(**options), "level", 1, "fold", 2)
    assert ask(df) is not None
    assert ask(df, maxBins=4) is None and ask(df.withColumn("label", F.col("label") + 0.5)) is None and ask(df.withColumn("fold", F.lit(0))) is None
    assert ask(df.withColumn("label", F.col("id").cast("double"))) is None and ask(df.filter("id < 0")) is None
    assert counted.known(RandomForestClassifier()) and not counted.known(RandomForestClassifier(weightCol="id")) and not counted.known(RandomForestClassifier(impurity="entropy"))
