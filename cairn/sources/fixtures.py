"""The engine's inputs, derived from the events, customer and lineitem tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import SchemaCatalog

LAGS = 7
#: event types that are conversions
CONVERSIONS = ("purchase", "signup")
#: event type behind each lag prefix
SIGNALS = {"adaLinkIn": "click", "aapLinkIn": "view", "aapLinkOut": "error"}

CATALOG = SchemaCatalog(
    cols_to_keep=("lag_clicks", "lag_views", "is_weekend", "is_month_start"), holiday_features=("is_weekend", "is_month_start"),
    traffic_features=("lag_clicks", "lag_views"), marketing_features=("lag_clicks", "lag_views"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a purchase or signup, with the user's click, view and error counts of that
    day and the six before. Daily counts are spread over the days they reach, so the join is an equi-join."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = events.groupBy("user_id", "day").agg(*[F.count_if(F.col("event_type") == e).alias(p) for p, e in SIGNALS.items()])
    reach = daily.filter(" or ".join(f"{p} > 0" for p in SIGNALS)).withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(LAGS - 1))))
    lags = reach.groupBy(F.col("user_id").alias("u"), F.date_add("day", F.col("lag")).alias("d")).agg(*[F.sum(F.when(F.col("lag") == i, F.col(p)).otherwise(0)).alias(f"{p}D{i}") for p in SIGNALS for i in range(LAGS)])
    base = events.filter(F.col("event_type").isin(*CONVERSIONS)).join(lags, (F.col("user_id") == F.col("u")) & (F.col("day") == F.col("d")), "left")
    return shaped(base, table(spark, sf_dir, "customer"))


def shaped(base: DataFrame, customers: DataFrame) -> DataFrame:
    """Conversion events with lag columns in the engine's input columns."""
    customer = customers.select("c_custkey", "c_mktsegment")
    wide = base.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
    return wide.select(
        F.col("event_id"), F.col("user_id").alias("adUserId"), F.unix_millis(F.col("ts").cast("timestamp")).alias("conversionTimestamp"),
        F.when(F.col("event_type") == "purchase", "orderItem").otherwise("signup").alias("conversionType"), F.lit("USD").alias("conversionCurrency"), F.col("value").alias("conversionOps"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("conversionIndicator"), (1 + F.col("event_id") % 3).alias("adCustomerOrderItemIdCount"),
        *[count(f"{p}D{i}") for p in SIGNALS for i in range(LAGS)],
        F.coalesce(F.col("c_mktsegment") == "BUILDING", F.lit(False)).alias("customerIsPrime"), F.coalesce(F.col("c_custkey") % 5, F.lit(0)).cast("int").alias("customerPropensityBucket"), F.coalesce("c_mktsegment", F.lit("NONE")).alias("customerRfm"),
        F.coalesce(F.col("adaLinkInD1") + F.col("adaLinkInD2"), F.lit(0)).cast("double").alias("lag_clicks"), F.coalesce(F.col("aapLinkInD1") + F.col("aapLinkInD2"), F.lit(0)).cast("double").alias("lag_views"))


def calendar(spark: SparkSession) -> DataFrame:
    """30 days of January 2024 but the 15th, which stays unmatched."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    days = spark.range(30).select(day.alias("calendar_date")).filter("calendar_date <> date '2024-01-15'")
    return days.select("calendar_date", F.date_format("calendar_date", "EEEE").alias("day_of_week"), F.weekday("calendar_date").isin(5, 6).cast("int").alias("is_weekend"), (F.dayofmonth("calendar_date") == 1).cast("int").alias("is_month_start"))


def line_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x array, w, y) of lineitem: price on intercept, quantity, discount, returned."""
    li = table(spark, sf_dir, "lineitem")
    x = F.array(F.lit(1.0), F.col("l_quantity"), F.col("l_discount"), F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))
    return li.select(x.alias("x"), (1 / (1 + F.col("l_linenumber"))).alias("w"), (F.col("l_extendedprice") / 10000).alias("y"))
