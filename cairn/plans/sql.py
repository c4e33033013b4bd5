"""SQL front end: the engine's formulas as SQL functions of a session, and its inputs as views.

register() makes temporary SQL functions, which Catalyst inlines like any expression, and
the views conversions, labelled and calendar, so that lifts, scores and weights can be asked for by
spark.sql alone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cairn.config import CONTROL, LiftConfig
from cairn.operators.features import label_treatments
from cairn.sources.fixtures import calendar, conversions

#: name, parameters, type and body.
FUNCTIONS = (
    ("purchase_weight", "items DOUBLE", "DOUBLE", "CASE WHEN items > 0 THEN 1 / items ELSE 1.0D END"),
    ("treated", "arm STRING, treatment STRING", "DOUBLE", "CASE WHEN arm = treatment THEN 1.0D ELSE 0.0D END"),
    ("aipw_factual", "y DOUBLE, t DOUBLE, p DOUBLE, m1 DOUBLE", "DOUBLE", "try_divide(t * (y - m1), p) + m1"),
    ("aipw_counterfactual", "y DOUBLE, t DOUBLE, p DOUBLE, m0 DOUBLE", "DOUBLE", "try_divide((1 - t) * (y - m0), 1 - p) + m0"),
    ("robust_lift", "f DOUBLE, cf DOUBLE", "DOUBLE", "CASE WHEN f IS NULL OR cf IS NULL THEN NULL WHEN f = 0 THEN 0.0D ELSE greatest(0.0D, 1 - try_divide(cf, f)) END"),
    ("platt", "score DOUBLE, slope DOUBLE, intercept DOUBLE", "DOUBLE", "1 / (1 + exp(-(slope * score + intercept)))"),
    ("class_weight", "n DOUBLE, total DOUBLE, classes DOUBLE", "DOUBLE", "sqrt(total / (classes * n))"),
    ("clip01", "x DOUBLE", "DOUBLE", "CASE WHEN x IS NULL THEN NULL ELSE greatest(0.0D, least(1.0D, x)) END"),
)


def register_functions(spark: SparkSession) -> list[str]:
    """Makes the functions; those of the same name are replaced."""
    for name, params, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {kind} RETURN {body}")
    conf = LiftConfig()
    either = " ".join(f"WHEN {t}_sum > {conf.imp_threshold} THEN '{t}'" for t in conf.treatments)
    every = " AND ".join(f"{t}_sum > {conf.imp_threshold}" for t in conf.treatments)
    params = ", ".join(f"{t}_sum BIGINT" for t in conf.treatments)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION exposure_arm({params}) RETURNS STRING RETURN CASE WHEN {every} THEN 'both_impressions' {either} ELSE '{CONTROL}' END")
    return [name for name, *_ in FUNCTIONS] + ["exposure_arm"]


def register(spark: SparkSession, sf_dir: str) -> None:
    """Functions, and views over the tables in a folder."""
    register_functions(spark)
    rows = conversions(spark, sf_dir)
    rows.createOrReplaceTempView("conversions")
    label_treatments(rows).createOrReplaceTempView("labelled")
    calendar(spark).createOrReplaceTempView("calendar")
