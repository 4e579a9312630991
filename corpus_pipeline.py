"""From raw documents to a training mix: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundalake.llm import decontam, langid, mixing, simhash, substring_dedup
from fundalake.llm.common import fresh_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the dictionaries recognise."""
    return langid.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least doc_id."""
    return simhash.deduplicated(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that are repeated."""
    return substring_dedup.applied(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no item of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: each document once for each copy that the mix takes, with copy and position."""
    return mixing.ordered(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]

#: Compression sizes and XXH64 have no SQL: the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        at = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
