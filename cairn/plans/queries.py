"""Registered queries of the lift engine and their DuckDB SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.config import CONTROL, LIFT_FIELDS
from cairn.functions.columns import floor_at, set_constants, set_zeros, within_sql
from cairn.operators import linear, metrics, propensity, report, robust, sampling
from cairn.operators.features import DAY_FEATURE, FeatureEngineering, IndicatorTransformer, attribute_names, bucketize_exposure, feature_pipeline, fit_pipeline, indexer_labels, label_treatments, marketing_mask, no_marketing_mask
from cairn.plans.engine import score, summarize, train
from cairn.sources import readers, sinks
from cairn.sources.fixtures import CATALOG, LAGS, SIGNALS, calendar, conversions, line_model, table

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
ARMS = ("aap", "ada", CONTROL)


def _register(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[name] = f
        if sql is not None:
            _sql[name] = sql
        return f

    return add


def _all_registered() -> None:
    """Modules that register queries of their own."""
    from cairn.plans import analysis, events, models  # noqa: F401


def queries() -> dict[str, Query]:
    _all_registered()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _all_registered()
    return dict(_sql)


def r6(c: Column | str, name: str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


#: Sums of few decimals are shown times this, so that none lies half-way between two roundings.
_SCALE = 0.7310585786


# ---- shared SQL ----

_SHORT = {"adaLinkIn": "c", "aapLinkIn": "v", "aapLinkOut": "e"}
_LAGS = ", ".join(f"CAST(coalesce(sum(d.{_SHORT[p]}) FILTER (WHERE b.day - d.day = {i}), 0) AS INT) AS {p}D{i}" for p in SIGNALS for i in range(LAGS))
CONV = f"""ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
daily AS (SELECT user_id, day, {", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {_SHORT[p]}" for p, e in SIGNALS.items())} FROM ev GROUP BY user_id, day),
lagged AS (SELECT b.event_id, {_LAGS} FROM ev b LEFT JOIN daily d ON b.user_id = d.user_id AND d.day BETWEEN b.day - {LAGS - 1} AND b.day WHERE b.event_type IN ('purchase', 'signup') GROUP BY b.event_id),
conv AS (SELECT l.*, b.user_id AS adUserId, epoch_ms(b.ts) AS conversionTimestamp, b.day AS date, CASE WHEN b.event_type = 'purchase' THEN 'orderItem' ELSE 'signup' END AS conversionType, b.value AS conversionOps,
  CASE WHEN b.event_type = 'purchase' THEN 1 ELSE 0 END AS conversionIndicator, 1 + b.event_id % 3 AS items, coalesce(c_mktsegment = 'BUILDING', FALSE) AS prime, CAST(coalesce(c_custkey % 5, 0) AS INT) AS bucket, coalesce(c_mktsegment, 'NONE') AS rfm,
  CAST(adaLinkInD1 + adaLinkInD2 AS DOUBLE) AS lag_clicks, CAST(aapLinkInD1 + aapLinkInD2 AS DOUBLE) AS lag_views
  FROM lagged l JOIN ev b USING (event_id) LEFT JOIN customer ON b.user_id = c_custkey)"""


def _sum(p: str) -> str:
    return "(" + " + ".join(f"{p}D{i}" for i in range(LAGS)) + ")"


LABELLED = f"""{CONV},
marked AS (SELECT *, {_sum('adaLinkIn')} AS ada_sum, {_sum('aapLinkIn')} AS aap_sum, CASE WHEN {_sum('adaLinkIn')} > 5 THEN 1 ELSE 0 END AS ada_in_imp_7, CASE WHEN {_sum('aapLinkIn')} > 5 THEN 1 ELSE 0 END AS aap_in_imp_7,
  CASE WHEN aapLinkOutD0 > 0 THEN 1 ELSE 0 END AS aap_out_imp_1, CASE WHEN {_sum('aapLinkOut')} > 0 THEN 1 ELSE 0 END AS aap_out_imp_7, CASE WHEN items > 0 THEN 1.0::DOUBLE / items ELSE 1.0 END AS purchase_weight FROM conv),
lab AS (SELECT *, CASE WHEN ada_in_imp_7 = 1 THEN 'ada' WHEN aap_in_imp_7 = 1 THEN 'aap' ELSE 'no_impression' END AS treatment_type FROM marked WHERE ada_in_imp_7 + aap_in_imp_7 < 2)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_treatments(conversions(spark, sf_dir))


# ---- inputs ----

@_register("lift_arms", f"WITH {LABELLED} SELECT treatment_type, count(*) AS n, round(avg(conversionIndicator), 6) AS conversion_rate, round(sum(conversionOps), 2) AS total_ops FROM lab GROUP BY treatment_type")
def lift_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).groupBy("treatment_type").agg(F.count("*").alias("n"), r6(F.avg("conversionIndicator"), "conversion_rate"), F.round(F.sum("conversionOps"), 2).alias("total_ops"))


@_register("read_dataset", "SELECT * FROM nation")
def read_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_dataset(spark, f"{sf_dir}/nation.parquet")


@_register("list_files", " UNION ALL ".join(f"SELECT '{t}.parquet' AS name, count(*) AS n_rows FROM {t}" for t in ("customer", "events", "orders")))
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of three tables, read by what the recursive listing of the folder finds of them."""
    names = ("customer", "events", "orders")
    table_of = F.regexp_extract("path", rf"/({'|'.join(names)})\.parquet", 1)
    found = readers.list_files(spark, sf_dir).select("path", table_of.alias("name")).filter("name <> ''").collect()
    rows = [spark.read.parquet(*sorted({r.path for r in found if r.name == n})).agg(F.lit(f"{n}.parquet").alias("name"), F.count("*").alias("n_rows")) for n in names]
    return reduce(DataFrame.unionByName, rows)


@_register("calendar_join", f"""WITH {CONV}, cal AS (SELECT CAST(d AS DATE) AS calendar_date, dayname(d) AS day_of_week, CASE WHEN isodow(d) > 5 THEN 1 ELSE 0 END AS is_weekend FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(d) WHERE d <> TIMESTAMP '2024-01-15')
SELECT CAST(date AS VARCHAR) AS date, CAST(calendar_date AS VARCHAR) AS calendar_date, day_of_week, is_weekend, count(*) AS n, round(sum(conversionOps), 2) AS total_ops FROM conv LEFT JOIN cal ON date = calendar_date GROUP BY ALL""")
def calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = readers.prepare_conversions(conversions(spark, sf_dir), calendar(spark))
    return joined.groupBy(F.col("date").cast("string").alias("date"), F.col("calendar_date").cast("string").alias("calendar_date"), "day_of_week", "is_weekend").agg(F.count("*").alias("n"), F.round(F.sum("conversionOps"), 2).alias("total_ops"))


@_register("default_columns", f"WITH {CONV} SELECT event_id, CASE WHEN conversionType = 'orderItem' THEN 1 ELSE 0 END AS conversionIndicator, CASE WHEN conversionType = 'orderItem' THEN 1 ELSE 0 END AS items FROM conv")
def default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = conversions(spark, sf_dir).drop("conversionIndicator", "adCustomerOrderItemIdCount")
    return readers.with_defaults(bare).select("event_id", "conversionIndicator", F.col("adCustomerOrderItemIdCount").alias("items"))


# ---- features ----

_EXPOSURE = ("ada_sum", "aap_sum", "ada_in_imp_7", "aap_in_imp_7", "aap_out_imp_1", "aap_out_imp_7")


@_register("exposure_features", f"WITH {LABELLED} SELECT event_id, {', '.join(_EXPOSURE)}, CAST(prime AS INT) AS customerIsPrime, 1 AS intercept, round(purchase_weight, 6) AS purchase_weight, treatment_type, CASE WHEN treatment_type = 'ada' THEN 1.0::DOUBLE ELSE 0.0 END AS is_treated_by_ada, CASE WHEN treatment_type = 'aap' THEN 1.0::DOUBLE ELSE 0.0 END AS is_treated_by_aap, CASE WHEN treatment_type = 'no_impression' THEN 1.0::DOUBLE ELSE 0.0 END AS is_treated_by_no_impression FROM lab")
def exposure_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("event_id", *_EXPOSURE, "customerIsPrime", "intercept", r6("purchase_weight", "purchase_weight"), "treatment_type", *[f"is_treated_by_{t}" for t in ARMS])


def _bucket_sql(c: str) -> str:
    return f"CASE WHEN {c} < 0.00001 THEN 0 WHEN {c} < 5 THEN 1 WHEN {c} < 200 THEN 2 ELSE 3 END"


@_register("exposure_buckets", f"WITH {CONV} SELECT event_id, CAST({_bucket_sql(_sum('adaLinkIn'))} AS DOUBLE) AS ada_in_imp_7_bucket, CAST({_bucket_sql(_sum('aapLinkIn'))} AS DOUBLE) AS aap_in_imp_7_bucket FROM conv")
def exposure_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucketize_exposure(conversions(spark, sf_dir)).select("event_id", "ada_in_imp_7_bucket", "aap_in_imp_7_bucket")


@_register("indicators", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS l_quantity, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS l_discount FROM lineitem")
def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return IndicatorTransformer(inputCols=["l_quantity", "l_discount"], thresholds=[25.0, 0.05]).transform(li)


@_register("constant_columns", "SELECT c_custkey, 0 AS c_nationkey, 7 AS seven, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer")
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return set_constants(set_zeros(c, ["c_nationkey"]), {"seven": 7}).withColumn("c_acctbal", floor_at(F.col("c_acctbal"), 0.0))


@_register("feature_vectors", f"""WITH {LABELLED}, cal AS (SELECT CAST(d AS DATE) AS calendar_date, CASE WHEN isodow(d) > 5 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(d) WHERE d <> TIMESTAMP '2024-01-15'),
r AS (SELECT rfm, row_number() OVER (ORDER BY rfm) AS i, count(*) OVER () AS k FROM (SELECT DISTINCT rfm FROM lab)), top AS (SELECT max(bucket) AS mb FROM lab),
v AS (SELECT event_id, treatment_type, bucket, mb, i, k, [CASE WHEN lag_clicks > 0 THEN 1 ELSE 0 END, CASE WHEN lag_views > 0 THEN 1 ELSE 0 END, coalesce(is_weekend, 0), coalesce(is_month_start, 0), aap_out_imp_1, aap_out_imp_7, CAST(prime AS INT)] AS f FROM lab JOIN r USING (rfm) LEFT JOIN cal ON date = calendar_date, top),
arms AS (SELECT treatment_type, row_number() OVER (ORDER BY treatment_type) - 1 AS t FROM (SELECT DISTINCT treatment_type FROM lab))
SELECT event_id, CAST(t AS DOUBLE) AS treatment_type_indexed, CAST(list_sum([f[j] * j FOR j IN range(1, 8)]) + CASE WHEN bucket < mb THEN 8 + bucket ELSE 0 END + CASE WHEN i < k THEN 7 + mb + i ELSE 0 END AS DOUBLE) AS weighted_sum,
  CAST(list_sum(f) + CASE WHEN bucket < mb THEN 1 ELSE 0 END + CASE WHEN i < k THEN 1 ELSE 0 END AS DOUBLE) AS plain_sum FROM v JOIN arms USING (treatment_type)""")
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    rows = readers.prepare_conversions(conversions(spark, sf_dir), calendar(spark))
    out = fit_pipeline(feature_pipeline(CATALOG, model_type="dre"), rows).transform(rows)
    x = vector_to_array("features")
    return out.select("event_id", "treatment_type_indexed", F.aggregate(F.transform(x, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v).alias("weighted_sum"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("plain_sum"))


_FEATURE_SUMS = "r AS (SELECT rfm, row_number() OVER (ORDER BY rfm) AS i, count(*) OVER () AS k FROM (SELECT DISTINCT rfm FROM lab)), top AS (SELECT max(bucket) AS mb FROM lab)"
_BUCKETS = {t: f"CAST({_bucket_sql(_sum(p))} AS INT)" for t, p in (("ada", "adaLinkIn"), ("aap", "aapLinkIn"))}


_VECTOR = f"""WITH {LABELLED}, cal AS (SELECT CAST(d AS DATE) AS calendar_date, CASE WHEN isodow(d) > 5 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(d) WHERE d <> TIMESTAMP '2024-01-15'),
r AS (SELECT rfm, row_number() OVER (ORDER BY rfm) AS i, count(*) OVER () AS k FROM (SELECT DISTINCT rfm FROM lab)), top AS (SELECT max(bucket) AS mb FROM lab),
slots AS (SELECT event_id, [1, CASE WHEN lag_clicks > 0 THEN 1 ELSE 0 END, CASE WHEN lag_views > 0 THEN 1 ELSE 0 END, coalesce(is_weekend, 0), coalesce(is_month_start, 0), aap_out_imp_1, aap_out_imp_7, CAST(prime AS INT)] || [CASE WHEN bucket = j THEN 1 ELSE 0 END FOR j IN range(mb)] || [CASE WHEN i = j THEN 1 ELSE 0 END FOR j IN range(1, k)] || [ada_in_imp_7, aap_in_imp_7] AS f FROM lab JOIN r USING (rfm) LEFT JOIN cal ON date = calendar_date, top)"""


@_register("no_marketing_features", f"""{_VECTOR} SELECT event_id, CAST(list_sum([f[j] * j FOR j IN range(1, len(f) + 1)]) AS DOUBLE) AS weighted_sum, CAST(list_sum([CASE WHEN j IN (2, 3, len(f) - 1, len(f)) THEN 0 ELSE f[j] * j END FOR j IN range(1, len(f) + 1)]) AS DOUBLE) AS nm_weighted_sum, CAST(len(f) AS INT) AS width FROM slots""")
def no_marketing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression's vectors at their whole width, and without marketing."""
    from pyspark.ml.functions import vector_to_array

    rows = readers.prepare_conversions(conversions(spark, sf_dir), calendar(spark))
    made = FeatureEngineering(rows, CATALOG)
    out = no_marketing_mask(marketing_mask(made.featurized, CATALOG, made.conf)).transform(made.featurized)
    total = lambda c: F.aggregate(F.transform(vector_to_array(c), lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return out.select("event_id", total("features").alias("weighted_sum"), total("nm_features").alias("nm_weighted_sum"), F.size(vector_to_array("features")).alias("width"))


@_register("weekday_encoding", f"""WITH {LABELLED}, cal AS (SELECT CAST(d AS DATE) AS calendar_date, dayname(d) AS day_of_week FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(d) WHERE d <> TIMESTAMP '2024-01-15'),
j AS (SELECT event_id, day_of_week FROM lab LEFT JOIN cal ON date = calendar_date), names AS (SELECT list(DISTINCT day_of_week ORDER BY day_of_week) FILTER (WHERE day_of_week IS NOT NULL) AS l FROM j)
SELECT event_id, CAST(CASE WHEN day_of_week IS NULL THEN len(l) ELSE list_position(l, day_of_week) - 1 END AS BIGINT) AS day_slot FROM j, names""")
def weekday_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of the one in the weekday's vector; the day that the calendar lacks has the place after all names."""
    from pyspark.ml.functions import vector_to_array

    rows = readers.prepare_conversions(conversions(spark, sf_dir), calendar(spark))
    out = FeatureEngineering(rows, CATALOG, model_type="dre", propensity_model="RandomForest").featurized
    return out.select("event_id", (F.array_position(vector_to_array(DAY_FEATURE), 1.0) - 1).alias("day_slot"))


# ---- filters, splits, samples ----

def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_scores(labelled(spark, sf_dir))


def with_scores(rows: DataFrame) -> DataFrame:
    """Labelled rows with stated propensities and outcome probabilities, for operators that need no fitted model."""
    base = F.col("customerPropensityBucket") / 10.0
    p = {"aap": 0.02 + base * 0.6, "ada": 0.03 + base * 0.5}
    return rows.withColumns({
        propensity.column_of("aap"): p["aap"], propensity.column_of("ada"): p["ada"], propensity.column_of(CONTROL): 1 - p["aap"] - p["ada"],
        "probability_counterfactual": 0.4 + base / 10, "aap_probability": 0.45 + base / 10, "ada_probability": 0.5 + base / 10})


_P = {"aap": "(0.02 + bucket / 10.0 * 0.6)", "ada": "(0.03 + bucket / 10.0 * 0.5)"}
_P[CONTROL] = f"(1 - {_P['aap']} - {_P['ada']})"
SCORED = LABELLED + f""",
scored AS (SELECT * , {', '.join(f'CAST({e} AS DOUBLE) AS {propensity.column_of(t)}' for t, e in _P.items())}, CAST(0.4 + bucket / 100.0 AS DOUBLE) AS m0, CAST(0.45 + bucket / 100.0 AS DOUBLE) AS aap_m1, CAST(0.5 + bucket / 100.0 AS DOUBLE) AS ada_m1 FROM lab)"""


@_register("range_filter", f"WITH {SCORED} SELECT event_id FROM scored WHERE {propensity.column_of('aap')} BETWEEN 0.05 AND 0.2")
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return propensity.filter_by_range(_scored(spark, sf_dir), propensity.column_of("aap"), 0.05, 0.2).select("event_id")


@_register("combined_filter", f"WITH {SCORED} SELECT event_id FROM scored WHERE {within_sql([propensity.column_of(t) for t in ARMS], 0.05, 0.8)}")
def combined_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).filter(within_sql([propensity.column_of(t) for t in ARMS], 0.05, 0.8)).select("event_id")


@_register("truncate_propensity", f"WITH {SCORED} SELECT event_id FROM scored WHERE {within_sql([propensity.column_of(t) for t in ARMS], 0.04, 0.9)}")
def truncate_propensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return propensity.truncate(_scored(spark, sf_dir), list(ARMS), 0.04, 0.9).select("event_id")


@_register("propensity_overlap", f"""WITH {SCORED}, b AS (SELECT greatest({', '.join(f'min({propensity.column_of(t)})' for t in ARMS)}) AS lo, least({', '.join(f'max({propensity.column_of(t)})' for t in ARMS)}) AS hi FROM scored)
SELECT event_id FROM scored, b WHERE lo > hi OR ({' AND '.join(f'{propensity.column_of(t)} BETWEEN lo AND hi' for t in ARMS)})""")
def propensity_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    return propensity.overlap(rows, rows, list(ARMS))[0].select("event_id")


@_register("treated_overlap", f"""WITH {SCORED}, b AS (SELECT greatest({', '.join(f'min({propensity.column_of(t)})' for t in ('aap', 'ada'))}) AS lo, least({', '.join(f'max({propensity.column_of(t)})' for t in ('aap', 'ada'))}) AS hi FROM scored)
SELECT event_id FROM scored, b WHERE lo > hi OR ({' AND '.join(f'{propensity.column_of(t)} BETWEEN lo AND hi' for t in ('aap', 'ada'))})""")
def treated_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    return propensity.overlap(rows, rows, ["aap", "ada"])[0].select("event_id")


@_register("arm_counts", f"WITH {LABELLED} SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(conversionIndicator) AS BIGINT) AS conversions FROM lab WHERE treatment_type = 'ada'")
def arm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = robust.treatment_index(list(ARMS), "ada")
    rows = labelled(spark, sf_dir).withColumn("treatment_type_indexed", sum((F.when(F.col("treatment_type") == t, float(i)).otherwise(0.0) for i, t in enumerate(ARMS)), F.lit(0.0)))
    return robust.arm_rows(rows, index).agg(F.count("*").alias("n"), F.sum("conversionIndicator").alias("conversions"))


_HASH = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8) AS BIGINT)"


@_register("hash_split", f"SELECT o_orderkey, {_HASH.format(k='o_orderkey')} % 100 < 10 AS is_test FROM orders")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_rows, test_rows = sampling.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("o_orderkey"))
    return train_rows.withColumn("is_test", F.lit(False)).unionByName(test_rows.withColumn("is_test", F.lit(True)))


@_register("class_split", "SELECT o_orderkey, percent_rank() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) < 0.2 AS is_test FROM orders")
def class_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.exact_split(table(spark, sf_dir, "orders"), "o_orderstatus", F.col("o_orderkey")).select("o_orderkey", "is_test")


@_register("balanced_split", f"WITH h AS (SELECT o_orderkey, o_orderstatus, {_HASH.format(k='o_orderkey')} AS h FROM orders) SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus, h // 4194304 ORDER BY h, CAST(o_orderkey AS VARCHAR)) <= round(count(*) OVER (PARTITION BY o_orderstatus, h // 4194304) * 0.2) AS is_test FROM h")
def balanced_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_rows, test_rows = sampling.balanced_split(table(spark, sf_dir, "orders"), "o_orderstatus", F.col("o_orderkey"))
    return train_rows.withColumn("is_test", F.lit(False)).unionByName(test_rows.withColumn("is_test", F.lit(True))).select("o_orderkey", "o_orderstatus", "is_test")


@_register("random_split")
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_rows, test_rows = sampling.random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train_rows.withColumn("is_test", F.lit(False)).unionByName(test_rows.withColumn("is_test", F.lit(True)))


@_register("fraction_sample")
def fraction_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fraction_sample(table(spark, sf_dir, "orders").select("o_orderkey"))


@_register("cap_sample")
def cap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.cap_sample(table(spark, sf_dir, "orders").select("o_orderkey"), 5000)


@_register("cap_classes")
def cap_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.cap_classes(labelled(spark, sf_dir), "treatment_type").select("event_id", "treatment_type")


@_register("cap_classes_exactly", f"WITH {LABELLED}, c AS (SELECT min(n) * 5 AS cap FROM (SELECT count(*) AS n FROM lab GROUP BY treatment_type)), k AS (SELECT event_id, treatment_type, row_number() OVER (PARTITION BY treatment_type ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS r FROM lab) SELECT event_id, treatment_type FROM k, c WHERE r <= cap")
def cap_classes_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.cap_classes_exactly(labelled(spark, sf_dir), "treatment_type", F.col("event_id")).select("event_id", "treatment_type")


# ---- aggregates ----

@_register("class_counts", f"WITH {LABELLED} SELECT treatment_type, count(*) AS n FROM lab GROUP BY treatment_type")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_counts(labelled(spark, sf_dir), "treatment_type")


@_register("class_weights", f"WITH {LABELLED}, n AS (SELECT treatment_type, count(*) AS n FROM lab GROUP BY treatment_type), g AS (SELECT treatment_type, sqrt(sum(n) OVER () / (count(*) OVER () * n)) AS g FROM n), w AS (SELECT treatment_type, g * count(*) OVER () / sum(g) OVER () AS w FROM g) SELECT treatment_type, round(w, 6) AS class_weight, count(*) AS n FROM lab JOIN w USING (treatment_type) GROUP BY treatment_type, w")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sampling.class_weights(labelled(spark, sf_dir), "treatment_type")
    return w.groupBy("treatment_type", r6("class_weight", "class_weight")).agg(F.count("*").alias("n"))


@_register("global_bounds", f"WITH {SCORED} SELECT {', '.join(f'round(min({propensity.column_of(t)}), 6) AS min_{t}, round(max({propensity.column_of(t)}), 6) AS max_{t}' for t in ARMS)} FROM scored")
def global_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).agg(*[c for t in ARMS for c in (r6(F.min(propensity.column_of(t)), f"min_{t}"), r6(F.max(propensity.column_of(t)), f"max_{t}"))])


@_register("quantiles", "SELECT round(quantile_cont(l_extendedprice, 0.025), 4) AS p025, round(quantile_cont(l_extendedprice, 0.5), 4) AS p500, round(quantile_cont(l_extendedprice, 0.975), 4) AS p975 FROM lineitem")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = sampling.quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.025, 0.5, 0.975])
    names = ("p025", "p500", "p975")
    return spark.createDataFrame([tuple(q)], ", ".join(f"{n} double" for n in names)).select(*[F.round(n, 4).alias(n) for n in names])


@_register("winsorize", "WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem) SELECT l_orderkey, l_linenumber, round(CASE WHEN l_extendedprice < lo THEN lo WHEN l_extendedprice > hi THEN hi ELSE l_extendedprice END, 4) AS l_extendedprice FROM lineitem, q")
def winsorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.winsorize(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice")
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 4))


# ---- linear model ----

_X = ("1.0", "l_quantity", "l_discount", "(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)")
_W, _Y = "(1.0::DOUBLE / (1 + l_linenumber))", "(l_extendedprice / 10000)"
_GRAM_SQL = ", ".join([f"round(sum({_W} * {_X[i]} * {_X[j]}), 4) AS g_{i}_{j}" for i in range(4) for j in range(i, 4)] + [f"round(sum({_W} * {_X[i]} * {_Y}), 4) AS m_{i}" for i in range(4)])


@_register("weighted_gram", f"SELECT {_GRAM_SQL} FROM lineitem")
def weighted_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    xs = [F.get("x", F.lit(i)) for i in range(4)]
    return line_model(spark, sf_dir).agg(*[F.round(c, 4).alias(n) for n, c in linear.gram_columns(xs, F.col("w"), F.col("y")).items()])


_WIDE = ("1.0", "l_quantity / 50", "l_discount * 10", "l_tax * 10", "(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)", "(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END)", "CAST(l_linenumber AS DOUBLE) / 7", "l_quantity * l_quantity / 2500", "l_discount * l_quantity / 5", "l_tax * l_discount * 100", "(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END)")
_WIDE_SQL = f"x AS (SELECT {_W} AS w, {_Y} AS y, [{', '.join(f'CAST({e} AS DOUBLE)' for e in _WIDE)}] AS x FROM lineitem)"


@_register("wide_gram", f"""WITH {_WIDE_SQL}, one AS (SELECT w, x || [y] AS v FROM x)
SELECT CAST(i - 1 AS INT) AS i, CAST(j - 1 AS INT) AS j, round(sum(w * v[i] * v[j]) * {_SCALE}, 3) AS g FROM one, range(1, {len(_WIDE) + 1}) a(i), range(1, {len(_WIDE) + 2}) b(j) WHERE i <= j GROUP BY i, j""")
def wide_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal equations at the width of real models, beyond what is spelled out in generated code; column k is the moment."""
    x = F.array(*[F.expr(e).cast("double") for e in _WIDE])
    k = len(_WIDE)
    g, m = linear.normal_equations(table(spark, sf_dir, "lineitem"), x, F.expr("1.0D / (1 + l_linenumber)"), F.expr("l_extendedprice / 10000"), k)
    rows = [(i, j, float(g[i, j] if j < k else m[i])) for i in range(k) for j in range(i, k + 1)]
    return spark.createDataFrame(rows, "i int, j int, g double").withColumn("g", F.round(F.col("g") * _SCALE, 3))


_B = (0.1, 0.15, -0.2, 0.05)
_E = f"({_Y} - ({' + '.join(f'({b}) * {x}' for b, x in zip(_B, _X, strict=True))}))"


@_register("sandwich_meat", "SELECT " + ", ".join(f"round(sum({_W} * {_W} * {_E} * {_E} * {_X[i]} * {_X[j]}), 4) AS s_{i}_{j}" for i in range(4) for j in range(i, 4)) + " FROM lineitem")
def sandwich_meat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linear.meat(line_model(spark, sf_dir), F.col("x"), F.col("w"), F.col("y"), np.array(_B))
    row = {f"s_{i}_{j}": float(found[i, j]) for i in range(4) for j in range(i, 4)}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} double" for n in row)).select(*[F.round(n, 4).alias(n) for n in row])


@_register("weighted_least_squares", f"""WITH s AS (SELECT sum({_W}) AS w, sum({_W} * l_quantity) AS x, sum({_W} * l_quantity * l_quantity) AS xx, sum({_W} * {_Y}) AS y, sum({_W} * l_quantity * {_Y}) AS xy FROM lineitem)
SELECT round((xx * y - x * xy) / (w * xx - x * x), 6) AS b_0, round((w * xy - x * y) / (w * xx - x * x), 6) AS b_1, round(y / w, 6) AS b0_0, 0.0::DOUBLE AS b0_1 FROM s""")
def weighted_least_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_model(spark, sf_dir)
    gram, moment = linear.normal_equations(rows, F.slice("x", 1, 2), F.col("w"), F.col("y"), 2)
    s = linear.solve(gram, moment, None, restricted=1)
    return spark.createDataFrame([tuple(round(float(v), 6) for v in (*s["b"], *s["b0"]))], "b_0 double, b_1 double, b0_0 double, b0_1 double")


_L = {"b": [0.2, 0.3], "b0": [0.5, 0.0], "cov": [[0.02, -0.01], [-0.01, 0.05]], "V": [[1.0, 0.4], [0.0, 0.0]]}


def _lift_sql(model: dict = _L, xs: tuple[str, ...] = ("1.0::DOUBLE", "l_quantity / 50"), zs: tuple[str, ...] = ("1.0::DOUBLE", "0.0::DOUBLE")) -> str:
    import numpy as np

    cov, v = np.array(model["cov"]), np.array(model["V"])
    vc, k = v @ cov, len(xs)
    vcv = vc @ v.T
    quad = lambda a, m, b: " + ".join(f"({m[i, j]}::DOUBLE) * {a}{i} * {b}{j}" for i in range(k) for j in range(k) if m[i, j])
    clip = lambda e: f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {e}))"
    dot = lambda b, c: " + ".join(f"{x}::DOUBLE * {c}{i}" for i, x in enumerate(model[b]))
    return f"""WITH x AS (SELECT l_orderkey, l_linenumber, {', '.join(f'{e} AS x{i}' for i, e in enumerate(xs))}, {', '.join(f'{e} AS z{i}' for i, e in enumerate(zs))} FROM lineitem),
p AS (SELECT *, {dot('b0', 'x')} AS pa, {dot('b', 'x')} AS pb, {dot('b0', 'z')} AS pan, {dot('b', 'z')} AS pbn FROM x),
u AS (SELECT *, {', '.join(f'z{i} / pa - x{i} * pan / (pa * pa) AS u{i}, -z{i} / pb + x{i} * pbn / pb AS t{i}' for i in range(k))}, {clip('1 - pan / pa')} AS la, {clip('1 - pbn / pb')} AS lb FROM p)
SELECT l_orderkey, l_linenumber, round({clip('lb - la')}, 6) AS liftWb, round(sqrt(greatest(0.0::DOUBLE, {quad('u', vcv, 'u')} + 2 * ({quad('u', vc, 't')}) + {quad('t', cov, 't')})), 6) AS liftWbStandardError, round(la, 6) AS liftMlaGnuA, round(lb, 6) AS liftMlaGnuB, round(pa, 6) AS pDenomMlaGnuA, round(pb, 6) AS pDenomMlaGnuB, round(pan, 6) AS pNumMlaGnuA, round(pbn, 6) AS pNumMlaGnuB FROM u"""


def _lift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    import numpy as np

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array(F.lit(1.0), F.col("l_quantity") / 50).alias("x"), F.array(F.lit(1.0), F.lit(0.0)).alias("x0"))
    return li.withColumn("prediction", linear.lift_struct(F.col("x"), F.col("x0"), {k: np.array(v) for k, v in _L.items()}))


@_register("lift_scores", _lift_sql())
def lift_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lift_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", *[r6(f"prediction.{c}", c) for c in LIFT_FIELDS])


#: A model of as many features as a real one has.
_K = len(_WIDE)
_LW = {"b": [0.2 + 0.03 * i for i in range(_K)], "b0": [0.5 + 0.02 * i for i in range(_K - 2)] + [0.0, 0.0],
       "cov": [[0.02 if i == j else 0.001 * ((i + j) % 3 - 1) for j in range(_K)] for i in range(_K)], "V": [[(1.0 if i == j else 0.0) if j < _K - 2 else 0.05 * i for j in range(_K)] if i < _K - 2 else [0.0] * _K for i in range(_K)]}
_ZW = tuple(e if i < _K - 2 else "0.0" for i, e in enumerate(_WIDE))


@_register("wide_lift_scores", _lift_sql(_LW, tuple(f"CAST({e} AS DOUBLE)" for e in _WIDE), tuple(f"CAST({e} AS DOUBLE)" for e in _ZW)))
def wide_lift_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, x0 = (F.array(*[F.expr(e).cast("double") for e in es]) for es in (_WIDE, _ZW))
    out = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", linear.lift_struct(x, x0, _LW).alias("p"))
    return out.select("l_orderkey", "l_linenumber", *[r6(f"p.{c}", c) for c in LIFT_FIELDS])


@_register("regression_output", f"SELECT l_orderkey AS adUserId, 'orderItem' AS conversionType, 'USD' AS conversionCurrency, {', '.join(LIFT_FIELDS)}, round(liftWb * 10, 5) AS miopsWb, round(liftMlaGnuA * 10, 5) AS miopsMlaGnuA, round(liftMlaGnuB * 10, 5) AS miopsMlaGnuB FROM ({_lift_sql()})")
def regression_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lift_rows(spark, sf_dir).select(F.col("l_orderkey").alias("adUserId"), F.lit("signup").alias("conversionType"), F.lit("USD").alias("conversionCurrency"), F.lit(10.0).alias("conversionOps"), "prediction")
    out = report.regression_output(rows)
    return out.select(*[r6(c, c) if c in LIFT_FIELDS else F.round(r6(F.col(c) / 10, c) * 10, 5).alias(c) if c.startswith("miops") else c for c in out.columns])


_STATS = ", ".join(f"round({e}, 4) AS {n}" for n, e in (("min", "min(value)"), ("max", "max(value)"), ("mean", "avg(value)"), ("sd", "stddev_samp(value)"), ("p50", "quantile_cont(value, 0.5)"), ("p25", "quantile_cont(value, 0.25)"), ("p10", "quantile_cont(value, 0.1)"), ("p75", "quantile_cont(value, 0.75)"), ("p90", "quantile_cont(value, 0.9)"), ("negative_frac", "avg(CASE WHEN value <= 0 THEN 1.0 ELSE 0.0 END)"), ("oneplus_frac", "avg(CASE WHEN value >= 1 THEN 1.0 ELSE 0.0 END)")))


@_register("prediction_summary", f"WITH l AS ({_lift_sql()}), u AS (UNPIVOT (SELECT {', '.join(LIFT_FIELDS)} FROM l) ON {', '.join(LIFT_FIELDS)} INTO NAME variable VALUE value) SELECT variable, {_STATS} FROM u GROUP BY variable")
def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _lift_rows(spark, sf_dir).select(*[r6(f"prediction.{c}", c) for c in LIFT_FIELDS])
    s = metrics.prediction_summary(flat).drop("skewness", "skewness_ref")
    return s.select("variable", *[F.round(c, 4).alias(c) for c in s.columns if c != "variable"])


@_register("prediction_skewness", "WITH m AS (SELECT avg(q) AS mean, stddev_samp(q) AS sd FROM (SELECT round(l_quantity / 50, 6) AS q FROM lineitem)) SELECT round(avg((round(l_quantity / 50, 6) - mean) ** 3) / any_value(sd) ** 3, 4) AS skewness, round(avg((round(l_quantity / 50, 6) - mean) ** 3) / any_value(sd) ** 6, 4) AS skewness_ref FROM lineitem, m")
def prediction_skewness(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "lineitem").select(r6(F.col("l_quantity") / 50, "q"))
    return metrics.prediction_summary(q, ("q",)).select(F.round("skewness", 4).alias("skewness"), F.round("skewness_ref", 4).alias("skewness_ref"))


# ---- doubly robust ----

def _aipw_sql() -> str:
    parts = []
    for t in ("ada", "aap"):
        e, treated = propensity.column_of(t), f"(CASE WHEN treatment_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0 END)"
        parts.append(f"{treated} * (conversionIndicator - {t}_m1) / NULLIF({e}, 0) + {t}_m1 AS {t}_f, (1 - {treated}) * (conversionIndicator - m0) / NULLIF(1 - {e}, 0) + m0 AS {t}_cf")
    return f"WITH {SCORED}, a AS (SELECT event_id, treatment_type, {', '.join(parts)} FROM scored)"


@_register("aipw_lift", _aipw_sql() + " SELECT event_id, " + ", ".join(f"round({t}_f, 6) AS {t}_factual, round({t}_cf, 6) AS {t}_counterfactual, round({t}_f - {t}_cf, 6) AS {t}_dre, round(CASE WHEN {t}_f = 0 THEN 0.0 ELSE greatest(0.0::DOUBLE, 1 - {t}_cf / {t}_f) END, 6) AS {t}_lift" for t in ("ada", "aap")) + " FROM a")
def aipw_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scored(spark, sf_dir)
    for t in ("ada", "aap"):
        out = robust.lift(robust.aipw(out, t, "conversionIndicator"), t)
    return out.select("event_id", *[r6(f"{t}_{c}", f"{t}_{c}") for t in ("ada", "aap") for c in ("factual", "counterfactual", "dre", "lift")])


def _robust_columns() -> str:
    parts = []
    for t in ("ada", "aap"):
        p, up = propensity.column_of(t), f"(CASE WHEN {t}_f = 0 THEN 0.0 ELSE greatest(0.0::DOUBLE, 1 - {t}_cf / {t}_f) END)"
        parts.append(f"round({p}, 6) AS {p}, round({p}, 6) AS normalized_{p}, round({t}_m1, 6) AS {t}_probability, round({t}_f, 6) AS {t}_factual, round({t}_cf, 6) AS {t}_counterfactual, round({t}_f - {t}_cf, 6) AS {t}_dre, round({up}, 6) AS {t}_lift, round({up} * conversionOps * {_SCALE}, 4) AS miops_{t.upper()}")
    return ", ".join(parts)


@_register("robust_output", _aipw_sql().replace("SELECT event_id, treatment_type, ", "SELECT *, ") + f" SELECT adUserId, 'USD' AS conversionCurrency, conversionOps, conversionIndicator, treatment_type, {_robust_columns()} FROM a")
def robust_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = propensity.calibrate(_scored(spark, sf_dir), ["ada", "aap"], None)
    for t in ("ada", "aap"):
        out = robust.lift(robust.aipw(out, t, "conversionIndicator"), t)
    out = report.robust_output(out, ["ada", "aap"])
    own = [c for c in out.columns if c[:3] in ("ada", "aap") and c != "adUserId" or c.startswith(("normalized_", "miops_"))]
    return out.select(*[F.round(F.col(c) * _SCALE, 4).alias(c) if c.startswith("miops_") else r6(c, c) if c in own else c for c in out.columns])


_EFFECT = "SELECT '{t}' AS treatment, '{n}' AS estimand, round(avg({t}_f - {t}_cf), 6) AS estimate, round(avg({t}_f - {t}_cf) - 1.96 * stddev_samp({t}_f - {t}_cf) / sqrt(count(*)), 6) AS ci_lo, round(avg({t}_f - {t}_cf) + 1.96 * stddev_samp({t}_f - {t}_cf) / sqrt(count(*)), 6) AS ci_hi FROM a{w}"


@_register("average_effects", _aipw_sql() + " UNION ALL ".join(" " + _EFFECT.format(t=t, n=n, w=f" WHERE treatment_type = '{t}'" if n == "ATT" else "") for t in ("ada", "aap") for n in ("ATE", "ATT")))
def average_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scored(spark, sf_dir)
    for t in ("ada", "aap"):
        out = robust.aipw(out, t, "conversionIndicator")
    e = robust.analytic_effects(out, ["ada", "aap"])
    return e.select("treatment", "estimand", *[r6(c, c) for c in ("estimate", "ci_lo", "ci_hi")])


@_register("bootstrap_effects")
def bootstrap_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = robust.aipw(_scored(spark, sf_dir), "ada", "conversionIndicator")
    return sinks.effects_table(spark, robust.effects(out, ["ada"], F.col("event_id")))


_REPLICATES = 48


@_register("bootstrap_replicates", _aipw_sql() + f""", r AS (SELECT ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15))::BIGINT AS k, ada_f - ada_cf AS v, CASE WHEN treatment_type = 'ada' THEN 1 ELSE 0 END AS t, lane FROM a, range({_REPLICATES // 4}) l(lane)),
h0 AS (SELECT v, t, lane, (k::UHUGEINT * 13787848793156543929 % 18446744073709551616 + xor((lane + 1)::UHUGEINT * 11400714819323198485 % 18446744073709551616, 12345::UHUGEINT)) % 18446744073709551616 AS h FROM r),
h1 AS (SELECT v, t, lane, xor(h, h // 1073741824) * 13787848793156543929 % 18446744073709551616 AS h FROM h0), h2 AS (SELECT v, t, lane, xor(h, h // 134217728) * 10723151780598845931 % 18446744073709551616 AS h FROM h1),
h3 AS (SELECT v, t, lane, xor(h, h // 2147483648) AS h FROM h2), u AS (SELECT v, t, 4 * lane + j AS replicate, CAST(h // CAST(65536 ** j AS UHUGEINT) % 65536 AS BIGINT) AS u FROM h3, range(4) x(j)),
w AS (SELECT v, t, replicate, {' + '.join(f'(u >= {s})::INT' for s in robust.POISSON_STEPS[:-1].tolist())} AS w FROM u)
SELECT CAST(replicate AS INT) AS replicate, round(sum(w * v) / sum(w), 6) AS ate, round(sum(w * v * t) / sum(w * t), 6) AS att FROM w GROUP BY replicate""")
def bootstrap_replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of bootstrap replicates, whose draws SQL can follow by arithmetic modulo 2^64."""
    out = robust.aipw(_scored(spark, sf_dir), "ada", "conversionIndicator")
    found = robust.bootstrap(out, {"ada": ("ada_dre", "is_treated_by_ada")}, F.col("event_id"), _REPLICATES)
    return found.select("replicate", r6("ate", "ate"), r6("att", "att"))


@_register("propensity_normalize", f"WITH {SCORED}, c AS (SELECT event_id, " + ", ".join(f"1 / (1 + exp(-(2.0::DOUBLE * {propensity.column_of(t)} - 0.5))) AS c_{t}" for t in ARMS) + " FROM scored) SELECT event_id, " + ", ".join(f"round(c_{t} / (c_aap + c_ada + c_no_impression), 6) AS {t}" for t in ARMS) + " FROM c")
def propensity_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    class Fixed:
        coefficients, intercept = (2.0,), -0.5

    out = propensity.calibrate(_scored(spark, sf_dir), list(ARMS), {t: Fixed for t in ARMS})
    return out.select("event_id", *[r6(f"normalized_{propensity.column_of(t)}", t) for t in ARMS])


# ---- written and read back ----

def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return sinks.generate_path(found, f"written-{uuid.uuid4().hex}") if found else tempfile.mkdtemp()


@_register("written_regression_scored", _sql["regression_output"])
def written_regression_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.generate_path(scratch(spark), "out")
    sinks.write_regression_scored(regression_output(spark, sf_dir), path)
    return readers.read_dataset(spark, path)


@_register("written_scored", _sql["robust_output"])
def written_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_dataset(spark, sinks.write_scored(robust_output(spark, sf_dir), scratch(spark)))


@_register("written_test_set", "SELECT o_orderkey, o_orderstatus FROM orders WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10")
def written_test_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = sampling.hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderkey"))[1]
    return readers.read_dataset(spark, sinks.write_test_set(test, scratch(spark)))


# ---- metrics ----

_GUESS = "CASE WHEN l_quantity > 30 THEN 'R' WHEN l_discount > 0.05 THEN 'A' ELSE 'N' END"
_FLAG = "CASE {c} WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0 ELSE 2.0 END"
_CONF = f"m AS (SELECT {_FLAG.format(c='l_returnflag')} AS label, {_FLAG.format(c='(' + _GUESS + ')')} AS prediction, count(*) AS n FROM lineitem GROUP BY 1, 2)"
_CLASS = _CONF + ", c AS (SELECT l.label, support, hit, coalesce(guessed, 0) AS guessed, CASE WHEN coalesce(guessed, 0) = 0 THEN 0.0 ELSE hit / guessed END AS p, hit / support AS r FROM (SELECT label, sum(n)::DOUBLE AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END)::DOUBLE AS hit FROM m GROUP BY label) l LEFT JOIN (SELECT prediction, sum(n)::DOUBLE AS guessed FROM m GROUP BY prediction) g ON l.label = g.prediction), f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM c)"


def _guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = lambda c: F.when(c == "A", 0.0).when(c == "N", 1.0).otherwise(2.0)
    guess = F.when(F.col("l_quantity") > 30, "R").when(F.col("l_discount") > 0.05, "A").otherwise("N")
    return table(spark, sf_dir, "lineitem").select(flag(F.col("l_returnflag")).alias("label"), flag(guess).alias("prediction"))


@_register("confusion_matrix", f"WITH {_CONF} SELECT label, prediction, n FROM m")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_guesses(spark, sf_dir))


@_register("class_metrics", f"WITH {_CLASS} SELECT label, CAST(support AS BIGINT) AS support, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM f")
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_metrics(metrics.confusion(_guesses(spark, sf_dir))).select("label", "support", *[r6(c, c) for c in ("precision", "recall", "f1")])


@_register("weighted_metrics", f'WITH {_CLASS} SELECT round(sum(hit) / sum(support), 5) AS accuracy, round(sum(f1 * support) / sum(support), 5) AS f1, round(sum(p * support) / sum(support), 5) AS "weightedPrecision", round(sum(r * support) / sum(support), 5) AS "weightedRecall" FROM f')
def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.weighted_metrics(metrics.confusion(_guesses(spark, sf_dir)))


# ---- models, end to end (fitted: no SQL) ----

def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.prepare_conversions(conversions(spark, sf_dir), calendar(spark))


@_register("regression_model")
def regression_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train(prepared(spark, sf_dir), CATALOG).regression.summary(spark)


@_register("regression_scoring")
def regression_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    return score(train(rows, CATALOG), rows)


@_register("propensity_model")
def propensity_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    pipeline = fit_pipeline(feature_pipeline(CATALOG, model_type="dre"), rows)
    featured, labels = pipeline.transform(rows), indexer_labels(pipeline)
    found = propensity.fit_propensity(featured, labels, "LogisticRegression")
    return found.transform(featured).select("event_id", *[propensity.column_of(x) for x in labels])


@_register("doubly_robust_effects")
def doubly_robust_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    bundle = train(rows, CATALOG, model_type="dre")
    return summarize(bundle, rows)


@_register("doubly_robust_scoring")
def doubly_robust_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    return score(train(rows, CATALOG, model_type="dre"), rows)


@_register("cross_validation")
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cairn.operators.tuning import cross_validate

    rows = prepared(spark, sf_dir)
    featured = fit_pipeline(feature_pipeline(CATALOG, model_type="dre"), rows).transform(rows).withColumn("conversionIndicator", F.col("conversionIndicator").cast("double")).select("features", "conversionIndicator")
    path = f"{scratch(spark)}/features"  # written once: each fold has a table of its own to train on and one to test on
    featured.write.parquet(path)
    featured = spark.read.parquet(path)
    found = cross_validate(featured, robust.outcome_classifier(), "conversionIndicator", {"numTrees": [5, 10], "maxDepth": [3]}, folds=3)
    return spark.createDataFrame([(i, float(m)) for i, m in enumerate(found.avgMetrics)], "candidate int, f1 double")


@_register("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    pipeline = fit_pipeline(feature_pipeline(CATALOG, model_type="dre"), rows)
    featured = pipeline.transform(rows)
    model = robust.fit_outcome(featured, indexer_labels(pipeline), "ada")
    return sinks.feature_importance(spark, model, attribute_names(featured))

