"""Rank over a whole table without moving all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_UNORDERED = (T.MapType, T.VariantType)


def global_rank(df: DataFrame, column: str, name: str = "rank", ranges: int | None = None) -> DataFrame:
    """``rank() over (order by column desc)``, ties share a rank and NULL ranks last; for any type that has an order.

    The rows are written once, in ranges of the value and, within a value, of a hash of the row, so a value that a third of
    the rows share lies in many ranges. The range is part of what is written. A range\'s summary tells how many rows it holds, its ends and
    how many rows have its lowest value; running sums over the summaries, one row per range, tell how many rows lie above each range
    and how many of these tie with its highest value. That value\'s rank follows from them; the other values are ranked within the range.
    """
    spark = df.sparkSession
    kind = df.schema[column].dataType
    if isinstance(kind, _UNORDERED):
        raise TypeError(f"{column} is of type {kind.simpleString()}, which has no order to rank by")
    value = F.col(column)
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, _UNORDERED)]
    order = [value.desc_nulls_last(), F.xxhash64(*hashed)]
    ranged = df.repartitionByRange(*([ranges] if ranges else []), *order)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "rank")

    # At most one row per range from here to ``places``.
    known = ranged.where(value.isNotNull()).select("_range", value.alias("_value"))
    ends = known.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    ends = materialize(ends, "ends")
    lowest = known.join(F.broadcast(ends.select("_range", "_low")), "_range").where("_value = _low")
    ends = ends.join(lowest.groupBy("_range").agg(F.count(F.lit(1)).alias("_ties")), "_range")
    down = Window.orderBy("_range")
    upto = Window.partitionBy("_low").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    above = F.coalesce(F.sum("_n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ends.withColumns({"_above": above, "_run": F.sum("_ties").over(upto)})
    tied = F.when(F.lag("_low").over(down) == F.col("_high"), F.lag("_run").over(down)).otherwise(0)
    places = materialize(placed.withColumn("_tied", tied).select("_range", "_n", "_high", "_above", "_tied"), "places")
    total = F.broadcast(places.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total")))

    within = F.rank().over(Window.partitionBy("_range").orderBy(value.desc_nulls_last()))
    rank = (
        F.when(value.isNull(), F.col("_total") + 1)
        .when(value == F.col("_high"), F.col("_above") - F.col("_tied") + 1)
        .otherwise(F.col("_above") + F.col("_within"))
    )
    ranked = ranged.withColumn("_within", within).join(F.broadcast(places), "_range", "left").crossJoin(total)
    return ranked.select(*df.columns, rank.cast("bigint").alias(name))
