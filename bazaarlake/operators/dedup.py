"""Keep one row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: tuple[str, ...] | list[str], newest_first: tuple[str, ...] = ("ingestion_timestamp",)
) -> DataFrame:
    """Latest row per key.

    All rows of one file share one ingest time, so the remaining columns break ties and make the
    result repeatable. Spark limits each group to its first row before the shuffle, so a key that
    holds a large share of the rows sends one row per input partition.
    """
    first = [*newest_first, *[c for c in ("run_id", "file_hash") if c in df.columns]]
    rest = [c for c in df.columns if c not in first and c not in keys]
    order = [F.col(c).desc_nulls_last() for c in [*first, *rest]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")
