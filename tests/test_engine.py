import hashlib

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cairn.config import LIFT_FIELDS, REGRESSION_COLUMNS, LiftConfig
from cairn.operators import linear, metrics, propensity, robust, sampling
from cairn.operators.features import ExposureTransformer, FeatureEngineering, IndicatorTransformer, label_treatments
from cairn.plans.engine import Bundle, score, train
from cairn.sources import readers, sinks
from cairn.sources.fixtures import CATALOG, calendar, conversions

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    df = readers.prepare_conversions(conversions(spark, SF), calendar(spark)).persist()
    yield df
    df.unpersist()


def sample(k=4, n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = np.c_[np.ones(n), rng.normal(size=(n, k - 1))]
    return x, rng.uniform(0.2, 1, n), x @ rng.normal(size=k) + rng.normal(size=n)


def frame(spark, x, w, y):
    return spark.createDataFrame([(r.tolist(), float(a), float(b)) for r, a, b in zip(x, w, y, strict=True)], "x array<double>, w double, y double")


@pytest.mark.parametrize("k", [3, linear.WIDE + 4])
def test_normal_equations(spark, k):
    x, w, y = sample(k)
    g, m = linear.normal_equations(frame(spark, x, w, y), F.col("x"), F.col("w"), F.col("y"), k)
    assert np.allclose(g, x.T @ (x * w[:, None])) and np.allclose(m, x.T @ (w * y))


def test_restricted_fit_leaves_the_last_columns_out():
    x, w, y = sample(5)
    g, m = x.T @ (x * w[:, None]), x.T @ (w * y)
    s = linear.solve(g, m, None, 2)
    assert np.allclose(s["b0"][:3], np.linalg.solve(g[:3, :3], m[:3])) and not s["b0"][3:].any()


@pytest.mark.parametrize("k", [4, linear.NARROW_LIFT + 2])
@pytest.mark.parametrize("corrected", [False, True])
def test_lift(spark, k, corrected):
    x, w, y = sample(k, 60)
    y = np.abs(y) + 3
    g, m = x.T @ (x * w[:, None]), x.T @ (w * y)
    b = np.linalg.solve(g, m)
    s = linear.solve(g, m, (x * ((y - x @ b) ** 2 * w**2)[:, None]).T @ x, 2)
    x0 = x * np.r_[np.ones(k - 1), 0]
    df = spark.createDataFrame([(a.tolist(), c.tolist()) for a, c in zip(x, x0, strict=True)], "x array<double>, x0 array<double>")
    got = df.select(linear.lift_struct(F.col("x"), F.col("x0"), s, corrected).alias("p")).select("p.*").toPandas()
    assert tuple(got.columns) == LIFT_FIELDS
    vc = s["V"] @ s["cov"]
    for i in range(len(x)):
        pa, pb, pan, pbn = x[i] @ s["b0"], x[i] @ s["b"], x0[i] @ s["b0"], x0[i] @ s["b"]
        j = np.array([1 / pa, -pan / pa**2, -1 / pb, pbn / (pb**2 if corrected else pb)])
        u, t = x0[i] * j[0] + x[i] * j[1], x0[i] * j[2] + x[i] * j[3]
        se = np.sqrt(max(0, u @ vc @ s["V"].T @ u + 2 * u @ vc @ t + t @ s["cov"] @ t))
        assert got.liftWbStandardError[i] == pytest.approx(se, abs=1e-9)
        assert got.liftMlaGnuB[i] == pytest.approx(min(1, max(0, 1 - pbn / pb)), abs=1e-9)


def test_lift_of_a_zero_prediction_is_null(spark):
    s = {"b": np.array([0.0]), "b0": np.array([0.0]), "cov": np.eye(1), "V": np.eye(1)}
    r = spark.range(1).select(linear.lift_struct(F.array(F.lit(1.0)), F.array(F.lit(0.0)), s).alias("p")).select("p.*").first()
    assert r.liftWb is None and r.liftMlaGnuA is None and r.liftWbStandardError is None


def test_exposure_edges(spark):
    """A null day leaves the row untreated; a sum at the threshold does not treat; both treatments drop the row."""
    lags = lambda p, first: ", ".join(f"{first if i == 0 else 0} AS {p}D{i}" for i in range(7))
    one = lambda i, a, b, items: f"SELECT {i} AS id, {lags('adaLinkIn', a)}, {lags('aapLinkIn', b)}, {lags('aapLinkOut', 1)}, true AS customerIsPrime, {items} AS adCustomerOrderItemIdCount"
    df = spark.sql(" UNION ALL ".join([one(1, "CAST(NULL AS INT)", 0, 1), one(2, 5, 0, 0), one(3, 6, 0, 4), one(4, 6, 6, 1), one(5, 0, 9, 2)]))
    got = {r.id: (r.treatment_type, r.purchase_weight) for r in label_treatments(df).collect()}
    assert got == {1: ("no_impression", 1.0), 2: ("no_impression", 1.0), 3: ("ada", 0.25), 5: ("aap", 0.5)}


def test_transformers_reload(spark, rows, tmp_path):
    for t in (ExposureTransformer(bucketize=True), IndicatorTransformer(inputCols=["lag_clicks"], thresholds=[1.0])):
        t.write().overwrite().save(str(tmp_path / "t"))
        again = type(t).load(str(tmp_path / "t"))
        assert again.transform(rows).collect() == t.transform(rows).collect()


def test_readers(spark, rows, tmp_path):
    some = rows.select("event_id", "conversionOps").limit(20)
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / fmt)
        some.repartition(2).write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path + "/deep")
        got = readers.read_dataset(spark, path)
        assert got.count() == 20 and set(got.columns) == {"event_id", "conversionOps"}
    with pytest.raises(ValueError):
        (tmp_path / "none").mkdir()
        (tmp_path / "none" / "x.txt").write_text("x")
        readers.read_dataset(spark, str(tmp_path / "none"))
    assert readers.parse_uri("s3://b/p/q") == readers.Uri("s3", "b", "p/q") and readers.parse_uri("/a").bucket == ""
    (tmp_path / "c.json").write_text('{"name": "a", "description": "holiday", "marketing_indicator": 1}\n{"name": "b", "description": "other", "marketing_indicator": 0}\n')
    c = readers.read_catalog(spark, str(tmp_path / "c.json"))
    assert c.holiday_features == ("a",) == c.marketing_features == c.cols_to_keep


def test_regression_round_trip(spark, rows, tmp_path):
    bundle = train(rows, CATALOG)
    scored = score(bundle, rows)
    assert tuple(scored.columns) == REGRESSION_COLUMNS
    assert scored.filter("liftWb < 0 or liftWb > 1").count() == 0
    bundle.save(str(tmp_path))
    again = score(Bundle.load(spark, str(tmp_path)), rows)
    assert sorted(map(str, again.collect())) == sorted(map(str, scored.collect()))


def test_doubly_robust(spark, rows, tmp_path):
    options = {"propensity_estimator": LogisticRegression(labelCol="treatment_type_indexed", weightCol="class_weight"), "outcome_estimator": RandomForestClassifier(labelCol="conversionIndicator", numTrees=3, maxDepth=2, seed=1), "replicates": 50}
    bundle = train(rows, CATALOG, model_type="dre", **options)
    assert {(e[0], e[1]) for e in bundle.robust.effects} == {(t, x) for t in ("ada", "aap") for x in ("ATE", "ATT")}
    scored = score(bundle, rows)
    assert "miops_ADA" in scored.columns and scored.filter("ada_lift < 0").count() == 0
    bundle.save(str(tmp_path))
    assert score(Bundle.load(spark, str(tmp_path)), rows).count() == scored.count()
    table = sinks.effects_table(spark, bundle.robust.effects)
    assert sinks.artifact(table).count() == 8
    assert set(bundle.robust.propensity.metrics["weighted"]) == {"accuracy", "f1", "weightedPrecision", "weightedRecall"}
    # an estimator and a model like any other: in a pipeline, saved and loaded
    from pyspark.ml import Pipeline, PipelineModel

    whole = Pipeline(stages=[*bundle.pipeline.stages, robust.DoublyRobust(bundle.labels, "LogisticRegression", **options)]).fit(rows)
    whole.write().overwrite().save(str(tmp_path / "whole"))
    again = PipelineModel.load(str(tmp_path / "whole"))
    assert again.stages[-1].effects == whole.stages[-1].effects and again.stages[-1].propensity.metrics == whole.stages[-1].propensity.metrics
    pick = ["event_id", "ada_lift", "aap_lift"]
    assert sorted(map(str, again.transform(rows).select(pick).collect())) == sorted(map(str, whole.transform(rows).select(pick).collect()))


def test_propensity_search_and_kept_probability(spark, rows):
    bundle = FeatureEngineering(rows, CATALOG, model_type="dre")
    found = propensity.fit_propensity(bundle.featurized, bundle.labels, "LogisticRegression", cross_validation=True, grid={"regParam": [0.01, 10.0]}, folds=2, test=bundle.featurized)
    assert found.best_params == {"regParam": 0.01} and set(found.metrics["classes"]) <= set(bundle.labels)
    out = found.transform(bundle.featurized.withColumn("probability", F.lit("mine")))
    assert out.filter("original_probability <> 'mine'").count() == 0 and "probability" not in out.columns
    assert bundle.names[0] == "lag_clicks" and bundle.processed is rows


def test_unknown_choices_raise(rows):
    with pytest.raises(ValueError):
        train(rows, CATALOG, model_type="other")
    with pytest.raises(ValueError):
        propensity.classifier("other")
    with pytest.raises(ValueError):
        robust.treatment_index(["a"], "b")
    with pytest.raises(ValueError):
        LiftConfig(look_back={})


def test_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select("id", (F.sin("id") + 1).alias("v"), (F.col("id") % 3 == 0).cast("double").alias("t"))
    runs = [robust.bootstrap(df.repartition(n), {"x": ("v", "t")}, F.col("id"), 200).orderBy("replicate").toPandas() for n in (1, 5)]
    assert np.allclose(runs[0][["ate", "att"]], runs[1][["ate", "att"]])
    v = df.toPandas().v
    assert runs[0].ate.std() == pytest.approx(v.std() / np.sqrt(2000), rel=0.25)


def test_bootstrap_draws_equal_rows_apart(spark):
    """Rows alike in all but their id are resampled one by one, several treatments in one pass."""
    df = spark.range(1000).select("id", (F.col("id") % 2).cast("double").alias("a_dre"), F.lit(1.0).alias("is_treated_by_a"), F.when(F.col("id") < 500, F.col("id") % 2).cast("double").alias("b_dre"), (F.col("id") < 100).cast("double").alias("is_treated_by_b"))
    with sampling.numbered(df.drop("id"), "_n") as rows:
        found = {(t, e): (m, lo, hi) for t, e, m, lo, hi in robust.effects(rows, ["a", "b"], F.col("_n"), 400)}
    for key, n in {("a", "ATE"): 1000, ("a", "ATT"): 1000, ("b", "ATE"): 500, ("b", "ATT"): 100}.items():
        mean, lo, hi = found[key]
        assert mean == pytest.approx(0.5, abs=0.02) and hi - lo == pytest.approx(2 * 1.96 * 0.5 / n**0.5, rel=0.25)


@pytest.mark.parametrize("k", [3, linear.WIDE + 4])
def test_rows_with_nulls_count_for_nothing(spark, k):
    x, w, y = sample(k)
    odd = [(None, 1.0, 1.0), ([1.0] * (k - 1) + [None], 1.0, 1.0), ([1.0] * k, None, 1.0), ([1.0] * k, 1.0, None), ([1.0] * (k - 1), 1.0, 1.0)]
    df = frame(spark, x, w, y).union(spark.createDataFrame(odd, "x array<double>, w double, y double"))
    g, m = linear.normal_equations(df, F.col("x"), F.col("w"), F.col("y"), k)
    assert np.allclose(g, x.T @ (x * w[:, None])) and np.allclose(m, x.T @ (w * y))
    b = np.linalg.solve(g, m)
    assert np.allclose(linear.meat(df, F.col("x"), F.col("w"), F.col("y"), b), (x * ((y - x @ b) ** 2 * w**2)[:, None]).T @ x)


def test_exact_quantiles_beyond_one_task(spark, monkeypatch):
    rng = np.random.default_rng(4)
    for v in (rng.normal(size=5000), rng.integers(0, 7, 5000).astype(float), np.zeros(3000)):
        df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "a double")
        want = np.quantile(v, [0, 0.013, 0.5, 0.977, 1])
        monkeypatch.setattr(sampling, "EXACT_ROWS", 200)
        assert np.allclose(sampling.quantiles(df, "a", [0, 0.013, 0.5, 0.977, 1]), want)
        values = df.select(F.col("a").alias("v")).filter("v is not null")
        got = sampling.order_statistics(values, [0, 7, 1500, len(v) - 1], 50)
        assert [got[r] for r in (0, 7, 1500, len(v) - 1)] == [np.sort(v)[r] for r in (0, 7, 1500, len(v) - 1)]
    assert sampling.quantiles(df.limit(0), "a", [0.5]) is None


def test_ranks_by_slices(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("a")).when(F.col("id") % 2 == 0, "b").alias("c"), (F.col("id") % 1500).alias("k"))
    got = sampling.ranked(df, "c", F.col("k")).toPandas()
    for _, rows in got.groupby("c", dropna=False):
        order = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k in rows.k)
        assert [order.index((hashlib.md5(str(k).encode()).hexdigest(), k)) for k in rows.k] == rows._rank.tolist() and (rows._size == len(rows)).all()


def test_platt_and_normalization(spark):
    df = spark.range(400).select(F.col("id"), (F.col("id") / 400).alias(propensity.column_of("a")), (1 - F.col("id") / 400).alias(propensity.column_of("b")), (F.col("id") % 400 > 200).cast("double").alias("is_treated_by_a"), (F.col("id") % 400 <= 200).cast("double").alias("is_treated_by_b"))
    out = propensity.calibrate(df, ["a", "b"], propensity.fit_calibrators(df, ["a", "b"])).toPandas()
    assert np.allclose(out[f"normalized_{propensity.column_of('a')}"] + out[f"normalized_{propensity.column_of('b')}"], 1)


def test_class_weights_sum_to_the_classes(spark):
    df = spark.range(100).select((F.col("id") % 10 == 0).cast("int").alias("c"))
    w = sampling.class_weights(df, "c").groupBy("c").agg(F.first("class_weight").alias("w")).agg(F.sum("w")).first()[0]
    assert w == pytest.approx(2)


def test_percentiles_of_all_columns_in_three_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    cols = {"smooth": rng.normal(size=60000), "few": rng.integers(0, 5, 60000) / 7.0, "tied": np.where(rng.random(60000) < 0.3, 0.25, rng.random(60000)), "short": np.where(np.arange(60000) < 11, np.arange(60000), np.nan)}
    path = np.stack(list(cols.values()), 1).tolist()
    df = spark.createDataFrame(path, ", ".join(f"{c} double" for c in cols)).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in cols]).persist()
    monkeypatch.setattr(sampling, "EXACT_ROWS", 3000)
    passes = []
    monkeypatch.setattr(sampling, "order_statistics", lambda *a, **k: passes.append(a))
    got = {r.variable: r for r in metrics.prediction_summary(df, tuple(cols)).collect()}
    assert not passes  # no column by itself
    for c, x in cols.items():
        want = np.nanquantile(x, [0.5, 0.25, 0.1, 0.75, 0.9])
        assert [got[c][f"p{p}"] for p in (50, 25, 10, 75, 90)] == pytest.approx(list(want), abs=1e-12)
    df.unpersist()


def test_class_weights_leave_rows_where_they_are(spark):
    df = spark.range(0, 4000, 1, 8).withColumn("c", (F.col("id") % 10 == 0).cast("double"))
    out = sampling.class_weights(df, "c")
    assert out.groupBy(F.spark_partition_id()).count().count() == 8  # not two, one for each class
    assert out.count() == 4000


def test_node_ids_give_the_same_trees(spark):
    x, _, y = sample(k=4, n=400)
    df = frame(spark, x, np.ones(400), (y > np.median(y)).astype(float)).select(array_to_vector("x").alias("features"), F.col("y").alias("conversionIndicator")).repartition(3).persist()
    assert robust.outcome_classifier().getCacheNodeIds() and propensity.classifier("RandomForest").getCacheNodeIds()
    plain = RandomForestClassifier(featuresCol="features", labelCol="conversionIndicator", numTrees=5, maxDepth=6, seed=3, minInstancesPerNode=5)
    trees = [[t.toDebugString.split("\n", 1)[1] for t in m.fit(df).trees] for m in (plain, plain.copy().setCacheNodeIds(True))]
    assert trees[0] == trees[1]
    df.unpersist()


def test_calibrators_score_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(x):
        seen.add(1)
        return (x % 7) / 10 + 0.1

    cols = {propensity.column_of(t): F.udf(score, "double")("id") for t in ("a", "b")} | {f"is_treated_by_{t}": (F.col("id") % (3 + i) == 0).cast("double") for i, t in enumerate("ab")}
    propensity.fit_calibrators(spark.range(200).withColumns(cols), ["a", "b"])
    assert seen.value == 200  # both scores are one function of the row


def test_common_support_that_empties_an_arm_is_none(spark):
    labels = ["a", "b", "c"]
    p = [(0.2, 0.2, 0.6), (0.45, 0.2, 0.35), (0.2, 0.45, 0.35)]  # the bounds are 0.35 to 0.45, where no three sum to 1
    rows = spark.createDataFrame([(float(i % 3), *p[i % 3]) for i in range(30)], "arm double, " + ", ".join(f"{propensity.column_of(x)} double" for x in labels))
    assert propensity.overlap_bounds(rows, labels) == (0.35, 0.45)
    assert [x.count() for x in propensity.overlap(rows, rows, labels)] == [0, 0]
    assert [x.count() for x in propensity.overlap(rows, rows, labels, "arm")] == [30, 30]
    wide = spark.createDataFrame([(float(i % 3), *((0.2, 0.4, 0.4) if i // 3 % 2 else (0.4, 0.25, 0.35))) for i in range(30)], rows.schema)
    assert [propensity.overlap(wide, wide, ["a", "c"], *arm)[0].count() for arm in ((), ("arm",))] == [15, 15]


def test_binary_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.1), (1.0, 1.0, 0.9), (1.0, 0.0, 0.4), (0.0, 0.0, 0.2)], "y double, prediction double, raw double")
    m = metrics.binary_metrics(df, "y", raw="raw")
    assert m["areaUnderROC"] == 1.0 and m["accuracy"] == 0.75


def test_empty_inputs(spark, rows):
    none = rows.limit(0)
    assert label_treatments(none).count() == 0
    assert sampling.cap_classes(none, "conversionType").count() == 0
    assert sampling.winsorize(none, "conversionOps").count() == 0


def test_streaming_scores(spark, rows, tmp_path):
    from cairn.streaming.scoring import score_stream

    raw = conversions(spark, SF)
    raw.write.parquet(str(tmp_path / "in"))
    bundle = train(rows, CATALOG)
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    q = score_stream(bundle, stream, str(tmp_path / "out"), str(tmp_path / "ck"), calendar(spark), available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == score(bundle, rows).count()
