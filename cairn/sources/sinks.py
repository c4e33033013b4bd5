"""Sinks: scored tables, pipelines, models, feature importances, effect estimates."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import FORMATS

EFFECTS_DDL = "treatment string, estimand string, estimate double, ci_lo double, ci_hi double"


def generate_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def flatten_dict(d: dict, prefix: str = "") -> dict:
    """Nested keys joined by a space."""
    out: dict = {}
    for k, v in d.items():
        key = f"{prefix} {k}" if prefix else str(k)
        out |= flatten_dict(v, key) if isinstance(v, dict) else {key: v}
    return out


def write_scored(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    target = generate_path(path, "scored_data")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(target)
    return target


def write_partitioned(df: DataFrame, path: str, by: list[str], rows_per_file: int = 5_000_000) -> str:
    """Replaces the partitions that df has rows of and leaves all others as they are, so a day is
    written again by writing that day. Rows are dealt by partition, large partitions to
    several tasks and small ones together, by their real sizes."""
    dealt = df.hint("rebalance", *by)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)
    return path


def write_regression_scored(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_pipeline(model: PipelineModel, path: str) -> str:
    target = generate_path(path, "data_pipeline")
    model.write().overwrite().save(target)
    return target


def write_test_set(df: DataFrame, path: str) -> str:
    target = generate_path(path, "final_test_data")
    df.write.mode("overwrite").parquet(target)
    return target


def feature_importance(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """(feature, importance) by the vector's own attribute names, one per vector slot."""
    values = (model.featureImportances if hasattr(model, "featureImportances") else model.coefficientMatrix.toArray().__abs__().mean(axis=0))
    values = values.toArray() if hasattr(values, "toArray") else values
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values, strict=True)], "feature string, importance double")


def write_models(spark: SparkSession, models: dict[str, object], names: list[str], path: str) -> None:
    """Every model under models/{name}, and its feature importances (as many rows as features)."""
    for name, model in models.items():
        model.write().overwrite().save(generate_path(path, "models", name))
        feature_importance(spark, model, names).coalesce(1).write.mode("overwrite").parquet(generate_path(path, "feature_importance", name))


def effects_table(spark: SparkSession, effects: list[tuple]) -> DataFrame:
    return spark.createDataFrame(effects, EFFECTS_DDL)


def artifact(effects: DataFrame) -> DataFrame:
    """(Key, Value) strings of an effects table, as the summary artifact has them."""
    ci = F.concat(F.lit("("), F.col("ci_lo").cast("string"), F.lit(", "), F.col("ci_hi").cast("string"), F.lit(")"))
    pair = lambda what, v: F.struct(F.concat_ws(" ", "treatment", "estimand", F.lit(what)).alias("Key"), v.alias("Value"))
    return effects.select(F.explode(F.array(pair("estimate", F.col("estimate").cast("string")), pair("ci", ci))).alias("x")).select("x.*")


def write_artifact(effects: DataFrame, path: str) -> str:
    """One small file: a few rows for each treatment."""
    target = generate_path(path, "model_artifact")
    artifact(effects).coalesce(1).write.mode("overwrite").parquet(target)
    return target
