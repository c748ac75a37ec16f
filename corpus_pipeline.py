"""A corpus pipeline in five stages, each with one operator of ``hazeline.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeline.llm import curriculum, decontaminate, ngram_join, quality_gbt, sharding
from hazeline.llm.store import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality_gbt.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' targets take them."""
    return curriculum.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("mixing sources", mixture),
    ("sharding", shards),
]

#: The classifier is not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
