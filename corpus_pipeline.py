"""A corpus from raw documents to shards: each stage's rows are the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeloom.llm.common import table
from edgeloom.llm.decontaminate import decontaminate
from edgeloom.llm.mixing import sample
from edgeloom.llm.quality import keep_good
from edgeloom.llm.sharding import shard
from edgeloom.llm.simhash import keep_one
from edgeloom.plans.rounds import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A fitted classifier and XXH64 are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
