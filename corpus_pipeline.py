"""Corpus pipeline over `documents`: each stage takes what the one before it kept.

Quality rules drop documents; of each group of near duplicates the one of smallest
doc_id stays; personal data is replaced by its kind; sources are mixed to target
weights in whole documents (a document may stand twice); the texts are encoded.
All but the last return the columns of documents. Lineage ends at each stage's
Parquet folder in the shared folder.

Edge cases: a null or empty text has no words and is rejected by the quality rules, so
later stages see none; a null lang or source is a group and a source of its own. Rows of
null or equal doc_id are told apart by a hash of the whole row, and never kept or dropped
for each other. Columns beyond those of documents pass through all stages but the last,
whatever their names. An empty table passes through every stage and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.bpe import digests, round_trip
from cairn.llm.env import staged
from cairn.llm.mixing import mix_documents
from cairn.llm.near_dup import drop_near_duplicates
from cairn.llm.pii import redact
from cairn.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = round_trip(docs.select("doc_id", "source", "lang", "text"))
    return digests(encoded, F.col("source"), F.col("lang"), F.col("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mix sources", mix_sources),
    ("encode", encode_bpe),
]

#: No stage but the mix has a statement in SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
