"""Registered queries of fitted models and of what their writers leave, with what SQL can state of them."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.columns import has_column
from cairn.operators import metrics, propensity, robust, tuning
from cairn.operators.features import FeatureEngineering, assembled_columns, attribute_names, feature_pipeline, fit_pipeline, indexer_labels
from cairn.operators.linear import LiftRegression
from cairn.plans.engine import ModelBuilder
from cairn.sources import readers, sinks
from cairn.sources.fixtures import CATALOG, calendar, conversions

from .queries import _BUCKETS, _FEATURE_SUMS, ARMS, LABELLED, _register, _sql, average_effects, prepared, scratch


def _featured(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, list[str]]:
    """Features and labels, written once: a forest passes over its rows for every level of its trees."""
    made = FeatureEngineering(prepared(spark, sf_dir), CATALOG, model_type="dre", **options)
    path = f"{scratch(spark)}/features"
    made.featurized.select("event_id", "features", "treatment_type", "treatment_type_indexed", "conversionIndicator", *[f"is_treated_by_{x}" for x in made.labels]).write.parquet(path)
    return spark.read.parquet(path), made.labels


# ---- the forest path ----

@_register("propensity_forest", f"WITH {LABELLED} SELECT event_id, 1.0::DOUBLE AS total, TRUE AS inside FROM lab")
def propensity_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Propensities of the default forest, calibrated by Platt scaling and normalized: of each row their sum, and whether all are in [0, 1]."""
    featured, labels = _featured(spark, sf_dir, propensity_model="RandomForest")
    found = propensity.fit_propensity(featured, labels, "RandomForest")
    found.calibrators = propensity.fit_calibrators(found.transform(featured), labels)
    out = found.transform(featured)
    parts = [F.col(f"normalized_{propensity.column_of(x)}") for x in labels]
    inside = F.forall(F.array(*parts), lambda p: p.between(0.0, 1.0))
    return out.select("event_id", F.round(sum(parts, F.lit(0.0)), 6).alias("total"), inside.alias("inside"))


@_register("calibration_certificate", "SELECT t.x AS treatment, TRUE AS balanced, TRUE AS rising FROM (VALUES ('aap'), ('ada'), ('no_impression')) t(x), (SELECT count(*) AS n FROM events)")
def calibration_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What Platt scaling of the forest must leave: with an intercept that is not penalized, calibrated probabilities
    have the arm's share as their mean (to 1e-3), and no calibrator falls with the score."""
    featured, labels = _featured(spark, sf_dir, propensity_model="RandomForest")
    found = propensity.fit_propensity(featured, labels, "RandomForest")
    scored = found.transform(featured)
    calibrators = propensity.fit_calibrators(scored, labels)
    logit = lambda x: 1 / (1 + F.exp(-(F.col(propensity.column_of(x)) * float(calibrators[x].coefficients[0]) + float(calibrators[x].intercept))))
    sums = scored.agg(*[F.abs(F.avg(logit(x)) - F.avg(f"is_treated_by_{x}")).alias(x) for x in labels]).first()
    return spark.createDataFrame([(x, bool(sums[x] <= 1e-3), bool(calibrators[x].coefficients[0] >= 0)) for x in labels], "treatment string, balanced boolean, rising boolean")


# ---- search ----

@_register("parameter_search")
def parameter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successive halving over the default grid of forests, 5 folds: every candidate of every rung, with its rows and metric."""
    featured, _ = _featured(spark, sf_dir)
    rows = featured.select("event_id", "features", F.col("conversionIndicator").cast("double").alias("conversionIndicator"))
    found = tuning.successive_halving(rows, robust.outcome_classifier(), "conversionIndicator", F.col("event_id"), parallelism=8)
    return spark.createDataFrame([(s.rung, s.params["numTrees"], s.params["maxDepth"], s.params["minInstancesPerNode"], s.rows, float(s.metric)) for s in found.scores], "rung int, trees int, depth int, leaf int, n_rows long, f1 double")


# ---- bucketized features ----

@_register("bucket_features", f"WITH {LABELLED}, {_FEATURE_SUMS} SELECT event_id, {_BUCKETS['ada']} AS ada_slot, {_BUCKETS['aap']} AS aap_slot, CAST(8 + mb + k - 1 + 8 AS INT) AS width, CAST(12 AS INT) AS inputs FROM lab JOIN r USING (rfm), top")
def bucket_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each row's vector in bucket mode: the place of the one in either treatment's four slots, the width, and the assembler's inputs."""
    made = FeatureEngineering(prepared(spark, sf_dir), CATALOG, bucketize=True)
    x, width = vector_to_array("features"), len(made.names)
    place = lambda start: (F.array_position(F.slice(x, start, 4), 1.0) - 1).cast("int")
    return made.featurized.select("event_id", place(width - 7).alias("ada_slot"), place(width - 3).alias("aap_slot"), F.size(x).alias("width"), F.lit(len(assembled_columns(made.pipeline))).alias("inputs"))


# ---- what writers leave ----

@_register("written_pipeline", _sql["feature_vectors"])
def written_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feature_vectors by a pipeline that was written and loaded."""
    rows = prepared(spark, sf_dir)
    path = scratch(spark)
    sinks.write_pipeline(fit_pipeline(feature_pipeline(CATALOG, model_type="dre"), rows), path)
    out = readers.load_pipeline(f"{path}/data_pipeline").transform(rows)
    x = vector_to_array("features")
    return out.select("event_id", "treatment_type_indexed", F.aggregate(F.transform(x, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v).alias("weighted_sum"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("plain_sum"))


_NAMES = "lag_clicks lag_views is_weekend is_month_start aap_out_imp_1 aap_out_imp_7 customerIsPrime".split()


@_register("written_importance", f"""WITH {LABELLED}, names AS (SELECT unnest([{', '.join(repr(n) for n in _NAMES)}]) AS feature UNION ALL SELECT 'customerPropensity_dummy_' || j FROM (SELECT unnest(range(max(bucket))) AS j FROM lab)
UNION ALL SELECT 'customerRfm_dummy_' || rfm FROM (SELECT DISTINCT rfm FROM lab) WHERE rfm <> (SELECT max(rfm) FROM lab))
SELECT m AS model, feature, TRUE AS share, 1.0::DOUBLE AS total FROM names, (VALUES ('outcome_no_impression'), ('propensity_model')) v(m)""")
def written_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances by feature as the models' writer leaves them: whether each is a share, and their sum by model, of an arm's outcome forest and the propensity forest."""
    featured, labels = _featured(spark, sf_dir)
    path = scratch(spark)
    models = {"outcome_no_impression": robust.fit_outcome(featured, labels, ARMS[-1]), "propensity_model": propensity.fit_propensity(featured, labels, "RandomForest").model}
    sinks.write_models(spark, models, attribute_names(featured), path)
    read = [spark.read.parquet(f"{path}/feature_importance/{n}").withColumn("model", F.lit(n)) for n in models]
    both = read[0].unionByName(read[1])
    total = both.groupBy("model").agg(F.round(F.sum("importance"), 6).alias("total"))
    return both.join(total, "model").select("model", "feature", F.col("importance").between(0, 1).alias("share"), "total")


_EFFECTS = _sql["average_effects"]


@_register("written_artifact", f"""WITH e AS ({_EFFECTS}) SELECT treatment || ' ' || estimand || ' estimate' AS "Key", estimate AS first, NULL::DOUBLE AS second FROM e UNION ALL SELECT treatment || ' ' || estimand || ' ci', ci_lo, ci_hi FROM e""")
def written_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary artifact of average_effects, read back and taken apart."""
    back = spark.read.parquet(sinks.write_artifact(average_effects(spark, sf_dir), scratch(spark)))
    number = r"(-?[0-9.]+(?:E-?[0-9]+)?)"
    part = lambda i: F.regexp_extract("Value", rf"^\(?{number}(?:, {number}\))?$", i).try_cast("double")
    return back.select("Key", part(1).alias("first"), part(2).alias("second"))


@_register("binary_areas", f"WITH {LABELLED} SELECT TRUE AS in_range, count(*) AS n FROM lab")
def binary_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the areas and shares of an arm's outcome forest are in [0, 1] and its area under ROC on its own rows is above one half."""
    featured, labels = _featured(spark, sf_dir)
    rows = featured.withColumn("conversionIndicator", F.col("conversionIndicator").cast("double"))
    found = metrics.binary_metrics(robust.fit_outcome(rows, labels, ARMS[-1]).transform(rows.filter(F.col("treatment_type") == ARMS[-1])), "conversionIndicator")
    good = all(0 <= v <= 1 for v in found.values()) and found["areaUnderROC"] > 0.5 and not has_column(rows, "rawPrediction")
    return rows.agg(F.lit(good).alias("in_range"), F.count("*").alias("n"))


@_register("regression_gradient", f"WITH {LABELLED}, {_FEATURE_SUMS} SELECT CAST(i AS INT) AS i, 0.0::DOUBLE AS gradient FROM (SELECT unnest(range(8 + mb + k - 1 + 2)) AS i FROM top, (SELECT max(k) AS k FROM r))")
def regression_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The certificate of the fitted lift regression on its own features: X'W e = 0 for every coefficient, relative to the norms, to 8 places."""
    made = FeatureEngineering(readers.prepare_conversions(conversions(spark, sf_dir), calendar(spark)), CATALOG)
    rows = made.featurized.select("features", "conversionIndicator", "purchase_weight").persist()
    try:
        model: LiftRegression = ModelBuilder.linear(made.conf)
        b = model.fit(rows).state()["b"]
        x, w = vector_to_array("features"), F.col("purchase_weight")
        lean = rows.select(x.alias("x"), w.alias("w"), F.col("conversionIndicator").cast("double").alias("y"))
        e = F.col("y") - F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in b]), lambda a, c: a * c), F.lit(0.0), lambda a, v: a + v)
        one = lean.withColumn("e", e).select(F.posexplode("x").alias("i", "x"), "w", "e").groupBy("i").agg((F.sum(F.col("w") * F.col("x") * F.col("e")) / F.greatest(F.sqrt(F.sum(F.col("w") * F.col("x") * F.col("x")) * F.sum(F.col("w") * F.col("e") * F.col("e"))), F.lit(1e-300))).alias("g"))
        found = [(r.i, abs(round(r.g, 8))) for r in one.collect()]  # one row a coefficient
    finally:
        rows.unpersist()
    return spark.createDataFrame(found, "i int, gradient double")
