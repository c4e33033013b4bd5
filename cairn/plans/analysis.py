"""Registered queries: effects at all levels, sketches, the QR fit, JSON, SQL functions, partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from cairn.functions import props
from cairn.operators import cube, linear, robust, sketches
from cairn.sources import readers, sinks
from cairn.sources.fixtures import calendar, table

from . import sql as front
from .queries import _P, _WIDE, _WIDE_SQL, LABELLED, _aipw_sql, _register, _sql, labelled, r6, scratch, with_scores

# ---- effects at all levels ----

_CAL = "cal AS (SELECT CAST(d AS DATE) AS calendar_date, dayname(d) AS day_of_week FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(d) WHERE d <> TIMESTAMP '2024-01-15')"
_BY = _aipw_sql().replace("SELECT event_id, treatment_type, ", "SELECT event_id, treatment_type, rfm, date, ") + f", {_CAL}, w AS (SELECT a.*, day_of_week FROM a LEFT JOIN cal ON date = calendar_date)," + """
u AS (""" + " UNION ALL ".join(f"SELECT rfm, day_of_week, '{t}' AS treatment, '{e}' AS estimand, {t}_f - {t}_cf AS v FROM w{f' WHERE treatment_type = {chr(39)}{t}{chr(39)}' if e == 'ATT' else ''}" for t in ("ada", "aap") for e in ("ATE", "ATT")) + ")"
_LEVELS = """ SELECT rfm AS segment, day_of_week AS weekday, CAST(GROUPING(rfm, day_of_week) AS BIGINT) AS level, treatment, estimand, count(v) AS n, round(avg(v), 6) AS estimate, round(avg(v) - 1.96 * stddev_samp(v) / sqrt(count(v)), 5) AS ci_lo, round(avg(v) + 1.96 * stddev_samp(v) / sqrt(count(v)), 5) AS ci_hi
FROM u GROUP BY GROUPING SETS ({sets}) HAVING count(v) > 0"""


def _effects(spark: SparkSession, sf_dir: str, sets: list[list[str]] | None) -> DataFrame:
    rows = readers.with_date(with_scores(labelled(spark, sf_dir)))
    for t in ("ada", "aap"):
        rows = robust.aipw(rows, t, "conversionIndicator")
    # the calendar is joined to cells of a day, not to rows
    cells = readers.join_calendar(cube.effect_cells(rows.withColumnRenamed("customerRfm", "segment"), ["ada", "aap"], ["segment", "date"]), calendar(spark))
    out = cube.effects_of_cells(cells.withColumnRenamed("day_of_week", "weekday"), ["segment", "weekday"], sets)
    return out.select("segment", "weekday", F.col("level").cast("long").alias("level"), "treatment", "estimand", "n", r6("estimate", "estimate"), F.round("ci_lo", 5).alias("ci_lo"), F.round("ci_hi", 5).alias("ci_hi"))


@_register("effects_cube", _BY + _LEVELS.format(sets="(rfm, day_of_week, treatment, estimand), (rfm, treatment, estimand), (day_of_week, treatment, estimand), (treatment, estimand)"))
def effects_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effects by segment and weekday at all levels; the rows of level 3 are average_effects."""
    return _effects(spark, sf_dir, None)


@_register("effects_rollup", _BY + _LEVELS.format(sets="(rfm, day_of_week, treatment, estimand), (rfm, treatment, estimand), (treatment, estimand)"))
def effects_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _effects(spark, sf_dir, cube.rollup_sets(["segment", "weekday"]))


# ---- sketches ----

def _stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches by event type and day, written to a table and read back."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    found = sketches.reach(events, ["event_type", "day"], "user_id").join(sketches.spread(events, ["event_type", "day"], "value"), ["event_type", "day"])
    return spark.read.parquet(sinks.write_partitioned(found, f"{scratch(spark)}/sketches", ["day"]))


@_register("reach_by_type", "SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS within, TRUE AS as_one_pass FROM events GROUP BY event_type")
def reach_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by event type: the exact count, whether the days' merged sketches are within three standard errors of it, and whether they say what one pass says."""
    events = table(spark, sf_dir, "events")
    merged = sketches.merged(_stored_sketches(spark, sf_dir).select("event_type", "reach"), ["event_type"]).select("event_type", sketches.size(F.col("reach")).alias("about"))
    once = sketches.reach(events, ["event_type"], "user_id").select("event_type", sketches.size(F.col("reach")).alias("once"))
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.lit(sketches.relative_error()) * F.col(b)
    return exact.join(merged, "event_type").join(once, "event_type").select("event_type", "users", near("about", "users").alias("within"), near("about", "once").alias("as_one_pass"))


@_register("reach_overlaps", """WITH u AS (SELECT DISTINCT event_type, user_id FROM events), p AS (SELECT a.event_type AS a, b.event_type AS b, count(b.user_id) FILTER (WHERE a.user_id = b.user_id) AS n FROM u a JOIN u b ON a.event_type < b.event_type GROUP BY ALL)
SELECT a, b, n AS users, TRUE AS within FROM p""")
def reach_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that two event types share: exactly, and whether the sketches' intersection is within three standard errors of the union."""
    merged = sketches.merged(_stored_sketches(spark, sf_dir).select("event_type", "reach"), ["event_type"])
    found = sketches.overlaps(merged, "event_type")
    users = table(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    exact = users.alias("x").join(users.alias("y"), (F.col("x.user_id") == F.col("y.user_id")) & (F.col("x.event_type") < F.col("y.event_type"))).groupBy(F.col("x.event_type").alias("a"), F.col("y.event_type").alias("b")).agg(F.count("*").alias("users"))
    joined = found.join(exact, ["a", "b"], "left").fillna(0, ["users"])
    return joined.select("a", "b", "users", (F.abs(F.col("n_both") - F.col("users")) <= F.lit(sketches.relative_error()) * F.col("n_either")).alias("within"))


@_register("spread_by_type", "SELECT event_type, p, TRUE AS within FROM events, (VALUES (0.1::DOUBLE), (0.5), (0.9)) v(p) GROUP BY event_type, p")
def spread_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether quantiles from the days' merged sketches stand within the rank error of their places among all values."""
    merged = sketches.merged(_stored_sketches(spark, sf_dir).select("event_type", "spread"), ["event_type"])
    asked = merged.select("event_type", F.inline(F.array(*[F.struct(F.lit(p).alias("p"), sketches.quantile(F.col("spread"), p).alias("q")) for p in (0.1, 0.5, 0.9)])))
    events = table(spark, sf_dir, "events").select("event_type", "value")
    ranks = events.join(asked, "event_type").groupBy("event_type", "p").agg(F.avg((F.col("value") < F.col("q")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("q")).cast("double")).alias("through"))
    return ranks.select("event_type", "p", ((F.col("below") - sketches.rank_error() <= F.col("p")) & (F.col("through") + sketches.rank_error() >= F.col("p"))).alias("within"))


# ---- the QR fit ----

@_register("regression_certificate", f"WITH {_WIDE_SQL} SELECT CAST(i AS INT) AS i, 0.0::DOUBLE AS gradient, 0.0::DOUBLE AS restricted_gradient FROM range({len(_WIDE)}) t(i), (SELECT count(*) AS n FROM x)")
def regression_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What least squares must leave: X'W e = 0, in all columns for the full fit, and for the restricted one
    in its own (0 is shown for the others). Each is shown relative to |x_i| |e| in the weighted norms, to 8 places."""
    x, w, y = F.array(*[F.expr(e).cast("double") for e in _WIDE]), F.expr("1.0D / (1 + l_linenumber)"), F.expr("l_extendedprice / 10000")
    rows = table(spark, sf_dir, "lineitem").select(x.alias("x"), w.alias("w"), y.alias("y"))
    k, q = len(_WIDE), 2
    found = linear.solve_qr(linear.qr_factor(rows, F.col("x"), F.col("w"), F.col("y"), k), q)
    e = {name: F.col("y") - linear.dot(F.col("x"), found[name].tolist()) for name in ("b", "b0")}
    sums = [F.struct(*[F.sum(F.col("w") * F.get("x", F.lit(i)) * r).alias(n) for n, r in e.items()], F.sqrt(F.sum(F.col("w") * F.get("x", F.lit(i)) * F.get("x", F.lit(i)))).alias("norm")) for i in range(k)]
    norms = [F.sqrt(F.sum(F.col("w") * r * r)).alias(f"norm_{n}") for n, r in e.items()]
    one = rows.agg(F.array(*sums).alias("s"), *norms).select(F.posexplode("s").alias("i", "s"), "norm_b", "norm_b0")
    share = lambda n: F.abs(F.round(F.col(f"s.{n}") / (F.col("s.norm") * F.col(f"norm_{n}")), 8))
    return one.select("i", share("b").alias("gradient"), F.when(F.col("i") < k - q, share("b0")).otherwise(0.0).alias("restricted_gradient"))


# ---- JSON ----

@_register("props_by_type", "SELECT event_type, key, count(*) AS n, count(*) AS n_numbers, sum(CAST(value AS DOUBLE)) AS total, min(CAST(value AS DOUBLE)) AS least, max(CAST(value AS DOUBLE)) AS most FROM (SELECT event_type, unnest(json_keys(props)) AS key, props FROM events) e, LATERAL (SELECT json_extract_string(props, '$.' || key) AS value) GROUP BY ALL")
def props_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return props.key_statistics(table(spark, sf_dir, "events"), ["event_type"], props.as_map(F.col("props")))


_BROKEN = "CASE WHEN event_id % 50 = 0 THEN substr(props, 1, length(props) - 1) WHEN event_id % 50 = 1 THEN NULL ELSE props END"


@_register("props_parsed", f"WITH b AS (SELECT event_id, {_BROKEN} AS props FROM events) SELECT event_id, CASE WHEN json_valid(props) THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, props IS NOT NULL AND NOT json_valid(props) AS malformed FROM b")
def props_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """props by the schema that the data has, where some rows are null and some were cut short; the latter are kept apart and put back as such."""
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(_BROKEN).alias("props"))
    good, bad = props.split_malformed(rows, "props")
    out = props.parsed(good, "props", "p", props.json_schema(rows, "props")).select("event_id", F.col("p.k").cast("long").alias("k"), F.lit(False).alias("malformed"))
    return out.unionByName(bad.select("event_id", F.lit(None).cast("long").alias("k"), F.lit(True).alias("malformed")))


# ---- stated in SQL ----

@_register("sql_lift_arms", _sql["lift_arms"])
def sql_lift_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    front.register(spark, sf_dir)
    days = lambda p: " + ".join(f"{p}LinkInD{i}" for i in range(7))
    return spark.sql(f"""SELECT exposure_arm({days('ada')}, {days('aap')}) AS treatment_type, count(*) AS n, round(avg(conversionIndicator), 6) AS conversion_rate, round(sum(conversionOps), 2) AS total_ops
        FROM conversions GROUP BY 1 HAVING treatment_type <> 'both_impressions'""")


@_register("sql_aipw_lift", _sql["aipw_lift"])
def sql_aipw_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    front.register(spark, sf_dir)
    p = {t: e.replace("bucket", "customerPropensityBucket") for t, e in _P.items()}
    base = {"ada": "0.5D + customerPropensityBucket / 100", "aap": "0.45D + customerPropensityBucket / 100"}
    parts = ", ".join(f"aipw_factual(conversionIndicator, treated(treatment_type, '{t}'), {p[t]}, {base[t]}) AS {t}_factual, aipw_counterfactual(conversionIndicator, treated(treatment_type, '{t}'), {p[t]}, 0.4D + customerPropensityBucket / 100) AS {t}_counterfactual" for t in base)
    shown = ", ".join(f"round({t}_factual, 6) AS {t}_factual, round({t}_counterfactual, 6) AS {t}_counterfactual, round({t}_factual - {t}_counterfactual, 6) AS {t}_dre, round(robust_lift({t}_factual, {t}_counterfactual), 6) AS {t}_lift" for t in base)
    return spark.sql(f"WITH s AS (SELECT event_id, {parts} FROM labelled) SELECT event_id, {shown} FROM s")


@_register("sql_class_weights", _sql["class_weights"])
def sql_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    front.register(spark, sf_dir)
    return spark.sql("""WITH c AS (SELECT treatment_type, count(*) AS n FROM labelled GROUP BY treatment_type), t AS (SELECT sum(n) AS total, count(*) AS classes FROM c),
        g AS (SELECT treatment_type, n, classes, class_weight(n, total, classes) AS g FROM c CROSS JOIN t), s AS (SELECT sum(g) AS sum_g FROM g)
        SELECT treatment_type, round(g * classes / sum_g, 6) AS class_weight, n FROM g CROSS JOIN s""")


# ---- partitioned sinks ----

@_register("written_partitions", f"""WITH {LABELLED} SELECT CAST(date AS VARCHAR) AS date, treatment_type, count(*) AS n, round(sum(conversionOps) * CASE WHEN date = DATE '2024-01-10' THEN 2 ELSE 1 END, 2) AS total_ops
FROM lab WHERE isodow(date) > 5 OR date = DATE '2024-01-10' GROUP BY date, treatment_type""")
def written_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by day, one day written again with doubled values, and weekends (with that day) read back through the calendar."""
    path = f"{scratch(spark)}/by_day"
    rows = labelled(spark, sf_dir).select(F.to_date(F.timestamp_millis("conversionTimestamp")).alias("date"), "event_id", "treatment_type", "conversionOps")
    sinks.write_partitioned(rows, path, ["date"])
    sinks.write_partitioned(rows.filter("date = date '2024-01-10'").withColumn("conversionOps", F.col("conversionOps") * 2), path, ["date"])
    days = spark.range(366).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day")).filter("weekday(day) >= 5 or day = date '2024-01-10'")
    kept = spark.read.parquet(path).join(days, F.col("date") == F.col("day"), "left_semi")
    return kept.groupBy(F.col("date").cast("string").alias("date"), "treatment_type").agg(F.count("*").alias("n"), F.round(F.sum("conversionOps"), 2).alias("total_ops"))
