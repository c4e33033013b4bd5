"""Registered queries over the event table in time: streams, as-of and interval joins, sessions, frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import temporal
from cairn.operators.features import label_treatments
from cairn.sources.fixtures import shaped, table
from cairn.streaming import lookback, windows

from .queries import _EXPOSURE, _SCALE, LABELLED, _register, scratch


def _finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """What a stream puts out of all that is there now, through its sink."""
    folder = scratch(spark)
    windows.append(stream, f"{folder}/out", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.event_stream(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events"))


def _totals() -> list[Column]:
    return [F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,6)")).alias("total")]


_MARK = "mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)"


def _shown(df: DataFrame) -> DataFrame:
    rest = [F.round(F.col(c).cast("double"), 4).alias(c) if c == "total" else F.col(c) for c in df.columns if not c.startswith("window_")]
    return df.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), *rest)


# ---- streams ----

@_register("stream_tumbling", f"""WITH {_MARK}, w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL)
SELECT epoch_us(s) AS start_us, epoch_us(s + INTERVAL 6 HOUR) AS end_us, event_type, n, total FROM w, mark WHERE s + INTERVAL 6 HOUR <= mark""")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_finished(spark, windows.windowed(_events(spark, sf_dir), "6 hours", ["event_type"], _totals())))


@_register("stream_sliding", f"""WITH {_MARK}, e AS (SELECT *, time_bucket(INTERVAL 2 HOUR, ts) - unnest(range(3)) * INTERVAL 2 HOUR AS s FROM events),
w AS (SELECT s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e GROUP BY ALL)
SELECT epoch_us(s) AS start_us, epoch_us(s + INTERVAL 6 HOUR) AS end_us, event_type, n, total FROM w, mark WHERE s + INTERVAL 6 HOUR <= mark""")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_finished(spark, windows.windowed(_events(spark, sf_dir), "6 hours", ["event_type"], _totals(), slide="2 hours")))


_SESSIONS = """e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), f AS (SELECT *, CASE WHEN p IS NULL OR ts - p > INTERVAL {gap} THEN 1 ELSE 0 END AS new FROM e),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM f)"""


@_register("stream_sessions", f"""WITH {_MARK}, {_SESSIONS.format(gap='4 HOUR')}, s AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 4 HOUR AS b, count(*) AS n, round(sum(value), 4) AS total FROM g GROUP BY user_id, no)
SELECT epoch_us(a) AS start_us, epoch_us(b) AS end_us, user_id, n, total FROM s, mark WHERE b <= mark""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_finished(spark, windows.sessions(_events(spark, sf_dir), "4 hours", ["user_id"], _totals())))


@_register("stream_exposure", f"WITH {LABELLED}, {_MARK} SELECT event_id, {', '.join(_EXPOSURE)}, treatment_type FROM lab, mark WHERE date + 1 <= mark")
def stream_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exposure_features from a stream with keyed state, for the days that the watermark has closed."""
    found = _finished(spark, lookback.look_back(_events(spark, sf_dir)))
    return label_treatments(shaped(found, table(spark, sf_dir, "customer"))).select("event_id", *_EXPOSURE, "treatment_type")


# ---- joins in time ----

@_register("last_touch", """WITH t AS (SELECT * FROM events WHERE event_type IN ('click', 'view')), p AS (SELECT * FROM events WHERE event_type = 'purchase')
SELECT p.event_id, t.event_id AS last_event_id, t.event_type AS last_event_type, round((epoch_us(p.ts) - epoch_us(t.ts)) / 1e6, 6) AS last_age FROM p ASOF LEFT JOIN t ON p.user_id = t.user_id AND p.ts > t.ts""")
def last_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's last click or view before it, and its age in seconds."""
    e = table(spark, sf_dir, "events")
    found = temporal.asof_join(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.filter("event_type in ('click', 'view')"), ["user_id"], "ts", "ts", ["event_id", "event_type"], tie=["event_id"])
    return found.select("event_id", "last_event_id", "last_event_type", F.round("last_age", 6).alias("last_age"))


@_register("impressions_before", """SELECT c.event_id, i.event_id AS impression_id, i.event_type AS impression_type, round((epoch_us(c.ts) - epoch_us(i.ts)) / 1e6, 6) AS age
FROM events c JOIN events i ON c.user_id = i.user_id AND i.ts BETWEEN c.ts - INTERVAL 18 HOUR AND c.ts WHERE c.event_type IN ('purchase', 'signup') AND i.event_type IN ('click', 'view')""")
def impressions_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a conversion and an impression at most 18 hours before it."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    found = temporal.interval_join(e.filter("event_type in ('purchase', 'signup')"), e.filter("event_type in ('click', 'view')"), ["user_id"], "ts", "ts", 18 * 3600, fineness=3, prefix="i_")
    age = F.round((temporal.micros(F.col("ts")) - temporal.micros(F.col("i_ts"))) / temporal.MICROS, 6)
    return found.select("event_id", F.col("i_event_id").alias("impression_id"), F.col("i_event_type").alias("impression_type"), age.alias("age"))


# ---- frames ----

@_register("user_sessions", f"""WITH {_SESSIONS.format(gap='8 HOUR')} SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS purchases, round(sum(value), 4) AS total FROM g GROUP BY user_id, no""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.sessionize(table(spark, sf_dir, "events"), ["user_id"], "ts", 8 * 3600)
    grouped = rows.groupBy("user_id", "session_start").agg(F.max("ts").alias("end"), F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.sum(F.col("value").cast("decimal(18,6)")).alias("total"))
    return grouped.select("user_id", F.unix_micros("session_start").alias("start_us"), temporal.micros(F.col("end")).alias("end_us"), "n", "purchases", F.round(F.col("total").cast("double"), 4).alias("total"))


@_register("event_neighbours", """SELECT event_id, lag(event_type) OVER w AS previous_event_type, lag(event_id) OVER w AS previous_event_id, lead(event_type) OVER w AS next_event_type, lead(event_id) OVER w AS next_event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def event_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.neighbours(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type"), ["user_id"], "ts", ["event_type", "event_id"], ["event_id"])
    return rows.select("event_id", *[f"{side}_{c}" for side in ("previous", "next") for c in ("event_type", "event_id")])


@_register("trailing_spend", f"""SELECT event_id, count(*) OVER w AS trailing_n, round(sum(value) OVER w, 4) AS trailing_sum, round(avg(value) OVER w * {_SCALE}, 4) AS trailing_mean FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 36 HOUR PRECEDING AND CURRENT ROW)""")
def trailing_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving sums and averages over the 36 hours up to each event."""
    rows = temporal.trailing(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", "value", 36 * 3600)
    return rows.select("event_id", F.col("trailing_n").cast("long").alias("trailing_n"), F.round("trailing_sum", 4).alias("trailing_sum"), F.round(F.col("trailing_mean") * _SCALE, 4).alias("trailing_mean"))
