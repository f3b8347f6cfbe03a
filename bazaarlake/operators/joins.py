"""Lookup joins and parent checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a table with one row per ``key``, which should be a written one.

    Spark broadcasts a right side that it has measured to be small. Beyond that both sides are shuffled by the key alone, and adaptive execution
    splits the left rows of a hot key over tasks at run time; it can do so because a written right side brings no partitioning of its own.
    """
    return left.join(right, key, "left")


def missing_parents(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows: ``(missing_key, row_count)``.

    The child is reduced to one row per key first, so a hot key cannot overload the anti join, and
    an anti join (unlike NOT IN) may shuffle when the parent is too large to broadcast.
    """
    counts = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    keys = parent.select(F.col(parent_key).alias("missing_key"))
    return counts.join(keys, "missing_key", "left_anti")
