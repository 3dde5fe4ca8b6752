"""A training corpus from `documents`: reject toxic texts, keep one of each group of
near-duplicates, remove documents that contain benchmark items, mix the sources, shard.

Each stage takes the documents its predecessor kept and returns documents; the
last adds the shard.  Stages are joined by Parquet tables in the shared folder.
Null and empty texts pass every filter; rows are kept whole with all their
columns; an empty table gives an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spillway.llm import decontaminate, minhash_dedup, mixing, sharding, toxicity
from spillway.llm.common import Workspace, table
from spillway.llm.queries import SHARDS


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.deduplicate(docs, Workspace(spark, "pipeline-dedup"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "pipeline-leaks"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, Workspace(spark, "pipeline-mix"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, SHARDS, Workspace(spark, "pipeline-shards"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The first two stages depend on a trained classifier and on signatures: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return docs
