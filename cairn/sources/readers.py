"""Readers: any of csv, json, parquet by path; the schema catalog; calendar; conversions; saved models."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairn.functions.columns import epoch_ms_to_date

FORMATS = ("csv", "json", "parquet")


@dataclass(frozen=True)
class Uri:
    scheme: str
    bucket: str
    prefix: str


def parse_uri(path: str) -> Uri:
    """Scheme, bucket (authority) and prefix; a plain path has the first two empty."""
    u = urlparse(path)
    return Uri(u.scheme, u.netloc, u.path.lstrip("/") if u.scheme else path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below; contents are not read."""
    root = path.rsplit("/*", 1)[0] if path.endswith(("/*", "/**")) else path
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def sniff_format(spark: SparkSession, path: str) -> tuple[str, str]:
    """Format and path of the first file, by name, that ends in a known suffix."""
    first = list_files(spark, path).filter(F.col("path").rlike(r"\.(" + "|".join(FORMATS) + r")(\.\w+)?$")).agg(F.min("path")).first()[0]
    if first is None:
        raise ValueError(f"no {', '.join(FORMATS)} file below {path}")
    fmt = next(f for f in FORMATS if f".{f}" in first.rsplit("/", 1)[-1])
    return fmt, first


def read_dataset(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str | None = None, multi_line: bool = False) -> DataFrame:
    """All files below path. Without a schema, that of one file holds for all (csv: header
    names, all strings). Splits are left to the scan and AQE."""
    if fmt is not None and fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    sample = path
    if fmt is None:
        fmt, sample = sniff_format(spark, path)
    options = {"csv": {"header": True}, "json": {"multiLine": multi_line}, "parquet": {}}[fmt]
    if schema is None:
        schema = spark.read.format(fmt).options(**options).load(sample).schema
    root = path.rsplit("/*", 1)[0] if path.endswith(("/*", "/**")) else path
    return spark.read.format(fmt).options(recursiveFileLookup=True, **options).schema(schema).load(root)


@dataclass(frozen=True)
class SchemaCatalog:
    """Feature lists by description, and the columns that a no-marketing world masks."""

    cols_to_keep: tuple[str, ...] = ()
    holiday_features: tuple[str, ...] = ()
    traffic_features: tuple[str, ...] = ()
    marketing_features: tuple[str, ...] = ()

    @staticmethod
    def of(rows: DataFrame) -> SchemaCatalog:
        """rows (name, description, marketing_indicator), one per column of the data."""
        r = rows.select("name", "description", F.col("marketing_indicator").cast("int").alias("m")).collect()
        named = lambda f: tuple(x.name for x in r if f(x))
        return SchemaCatalog(
            named(lambda x: x.description != "other"), named(lambda x: x.description == "holiday"),
            named(lambda x: x.description in ("transit", "last_touch", "interaction")), named(lambda x: x.m == 1))


def read_catalog(spark: SparkSession, path: str) -> SchemaCatalog:
    return SchemaCatalog.of(spark.read.json(path))


def typed_calendar(calendar: DataFrame, holiday_features: tuple[str, ...] = ()) -> DataFrame:
    casts = {"calendar_date": F.to_date("calendar_date")} | {c: F.col(c).try_cast("int") for c in holiday_features}
    return calendar.withColumns(casts)


def read_calendar(spark: SparkSession, path: str, holiday_features: tuple[str, ...] = ()) -> DataFrame:
    return typed_calendar(read_dataset(spark, path), holiday_features)


def join_calendar(conversions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on the day. A calendar has one row a day, so Spark, which knows the size of its
    files, broadcasts it; no hint has it broadcast one that is too large."""
    return conversions.join(calendar, conversions["date"] == calendar["calendar_date"], "left")


def with_date(conversions: DataFrame, timestamp: str = "conversionTimestamp") -> DataFrame:
    return conversions.withColumn("date", epoch_ms_to_date(F.col(timestamp)))


def with_defaults(conversions: DataFrame) -> DataFrame:
    """Adds conversionIndicator and adCustomerOrderItemIdCount where they are missing."""
    purchase = F.when(F.col("conversionType") == "orderItem", 1).otherwise(0)
    missing = {c: purchase for c in ("conversionIndicator", "adCustomerOrderItemIdCount") if c not in conversions.columns}
    return conversions.withColumns(missing) if missing else conversions


def prepare_conversions(raw: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    dated = with_date(raw)
    return with_defaults(dated if calendar is None else join_calendar(dated, calendar))


def read_conversions(spark: SparkSession, path: str, calendar: DataFrame | None = None) -> DataFrame:
    return prepare_conversions(read_dataset(spark, path), calendar)


def load_stage(spark: SparkSession, path: str):
    """A saved ML model of whatever class its metadata names; errors are raised."""
    meta = DefaultParamsReader.loadMetadata(path, spark)
    name = meta["class"].replace("org.apache.spark", "pyspark")
    module, _, cls = name.rpartition(".")
    parts = module.split(".")
    for k in range(len(parts), 0, -1):  # Scala packages name one more level than Python modules may
        try:
            found = getattr(__import__(".".join(parts[:k]), fromlist=[cls]), cls)
        except (ImportError, AttributeError):
            continue
        return found.load(path)
    raise ValueError(f"no Python class for {meta['class']}")


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
