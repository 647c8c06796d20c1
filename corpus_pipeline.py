"""A training corpus from ``documents``: quality rules, near duplicates, decontamination, mixing, sharding.

Every stage takes what its predecessor kept and returns a DataFrame; ``run`` writes each one below the shared folder and
reads it again, as a chain of jobs would, so that a lost executor costs at most one stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.llm import decontaminate, mixing, ngram_join, quality_rules, sharding
from bazaarlake.llm.common import table
from bazaarlake.session import work_dir

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and its number therein."""
    return sharding.assign(docs, sharding.balanced_map(docs, SHARDS, work_dir(spark, "slot-map")))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("sharding", shards),
]

#: The LSH forest and the banded alignment can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = work_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
