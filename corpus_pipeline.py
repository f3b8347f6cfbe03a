"""A corpus pipeline of five operators: screen, thin out near copies, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and returns a table; all but the
last return the columns of ``documents``. ``run`` writes each stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.llm import decontamination, jaccard, mixing, sharding, toxicity
from bazaarlake.llm.storage import store

SHARDS = 8


def screen_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar doesn't reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the least doc_id."""
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each epoch that takes them."""
    return mixing.draw_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.shard_rows(docs, "doc_id", SHARDS)


STAGES = [
    ("toxicity", screen_toxic),
    ("ngram_jaccard", one_of_each),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Learned weights and shingle hashes are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
