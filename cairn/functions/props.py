"""JSON and map columns: a schema from the data, parsed values, malformed rows kept apart, aggregates by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def malformed(c: Column) -> Column:
    """Not null and not JSON."""
    return c.isNotNull() & F.try_parse_json(c).isNull()


def split_malformed(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose column is JSON or null, and the others as they are."""
    bad = malformed(F.col(f"`{col}`"))
    return df.filter(~bad), df.filter(bad)


def json_schema(df: DataFrame, col: str) -> StructType:
    """What all rows' objects have, by one aggregate: fields of any row, with the narrowest type
    that holds their values in all. Malformed rows count for nothing; where no row has an object, no fields."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{col}`"))).alias("s")).first().s
    if not found.startswith("OBJECT<"):
        return StructType()
    ddl = found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    schema = df.sparkSession.createDataFrame([], f"v {ddl}").schema["v"].dataType
    return schema


def parsed(df: DataFrame, col: str, out: str, schema: StructType | None = None) -> DataFrame:
    """Adds the struct of a JSON column; a malformed row's is null."""
    c = F.col(f"`{col}`")
    value = F.from_json(c, json_schema(df, col) if schema is None else schema)
    return df.withColumn(out, F.when(malformed(c), None).otherwise(value))


def as_map(c: Column) -> Column:
    """map<string, string> of a JSON object's top level; null where it is malformed."""
    return F.when(malformed(c), None).otherwise(F.from_json(c, "map<string,string>"))


def key_statistics(df: DataFrame, by: list[str], map_column: Column) -> DataFrame:
    """(by, key, n, n_numbers, total, least, most) over the entries of a map column; only entries are shuffled, after partial sums."""
    entries = df.select(*by, F.explode(map_column).alias("key", "value")).withColumn("number", F.col("value").try_cast("double"))
    return entries.groupBy(*by, "key").agg(F.count("*").alias("n"), F.count("number").alias("n_numbers"), F.sum("number").alias("total"), F.min("number").alias("least"), F.max("number").alias("most"))


def summed_maps(df: DataFrame, by: list[str], map_column: Column) -> DataFrame:
    """(by, sums: map of each key's sum), keys in order; a group's keys must be few enough for one row."""
    entries = key_statistics(df, by, map_column)
    return entries.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "total")))).alias("sums"))
