"""Labelled rows for learning: a bounded sample, joined to its texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; null for a null key."""
    return F.crc32(key.cast("string")) % by


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(``text``, ``y``) of at most ``rows`` distinct labelled rows that may be learned from.

    The rows are those with the least hashes of doc_id. Null labels and null ids are left out. Copies of a
    text count once, so that a large group of copies doesn't stand for many witnesses.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").groupBy(F.xxhash64("text").alias("_mark")).agg(
        F.min_by("text", "doc_id").alias("text"), F.max("y").alias("y")
    ).select("text", "y")
