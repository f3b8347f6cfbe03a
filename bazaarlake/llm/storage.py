"""Intermediate tables in the shared folder, and the numbers that size them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.session import scratch_path


def store(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, amount: float, per_task: float) -> int:
    """As many tasks as keep ``amount`` at ``per_task`` each, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((amount or 0) / per_task), 1)
