"""From raw documents to a sharded training mix, in five stages.

Each stage reads what the one before has written. Documents whose language is rejected go, one
document of each group of near copies stays, documents with benchmark windows go, sources are mixed
to their target weights (a document that the mix takes twice is there twice), and what is left is
placed in shards. All stages but the last return the columns of ``documents``, others included.

Defined cases: rows with a null or letterless text go in the first stage, having no language; rows
with a null doc_id, source or lang are rows like any other; of repeated rows, as of any group of
copies, one stays; an empty table stays empty; without a benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeweave.llm import langid, leaks, mixing, neardup, slots
from gradeweave.llm.shipping import ship
from gradeweave.sources.shared import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return slots.shard(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: The language model and the consistent samples cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
