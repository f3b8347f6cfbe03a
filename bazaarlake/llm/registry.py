"""Registered queries of the operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import ann, audit, decontamination, jaccard, lm, mixing, neardup, quality, secrets, sharding, substrings, toxicity, whitening
from bazaarlake.llm.oracle import SQL

SHARDS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by jump hashing of doc_id, under the law ``key``."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard_rows(docs, "doc_id", SHARDS).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the bigrams of the corpus."""
    return lm.backoff_scores(_table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, spans of all kinds."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin(*[r.name for r in secrets.BASE]))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(r.name) for r in secrets.BASE],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("found")).alias("spans"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it holds."""
    return decontamination.decontamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that start in documents of smaller id."""
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document."""
    mixed = mixing.mix_documents(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and the least doc_id it links to."""
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove at each step of each of their 120 orders, per language of all documents."""
    return audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the 16 leading components of the covariance of all distinct vectors."""
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"))


def op13_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with the number of vectors it is close to and its group of near copies."""
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_lm_scoring, op3_secret_scans, op4_decontamination, op5_toxicity,
        op6_nearest_neighbours, op7_suffix_dedup, op8_source_mixing, op9_quality, op10_ngram_jaccard,
        op11_filter_audit, op12_embedding_whitening, op13_embedding_neardup,
    )
}
ORACLE: dict[str, str] = SQL
