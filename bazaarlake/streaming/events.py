"""Counters and alerts over the structured log events.

Every function takes a stream or a table of events: ``(timestamp, event, status, duration_ms, ...)``.
On a stream the watermark bounds the state to the windows still open; run and batch ids are never
used as labels, so the state holds one row per window and event name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import delete_path, materialize

# Counted events and the name of their counter; the alert window and threshold.
COUNTERS = {
    "pipeline_completed": "pipeline_success_count",
    "file_rejected": "rejected_file_count",
    "duplicate_file_detected": "duplicate_file_count",
}
FAILURE_EVENT = "pipeline_failed"
REJECTION_EVENT = "file_rejected"
WINDOW = "5 minutes"
THRESHOLD = 0


def _windowed(events: DataFrame, window: str, lateness: str, *labels: str):
    return events.withWatermark("timestamp", lateness).groupBy(F.window("timestamp", window).alias("w"), *labels)


def _bounds() -> list[Column]:
    return [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]


def event_counts(events: DataFrame, window: str = WINDOW, lateness: str = "10 minutes") -> DataFrame:
    """Successful, rejected and duplicate files per window."""
    name = F.create_map(*[F.lit(x) for pair in COUNTERS.items() for x in pair])
    counted = events.where(F.col("event").isin(*COUNTERS)).withColumn("metric", name[F.col("event")])
    return _windowed(counted, window, lateness, "metric").agg(F.count(F.lit(1)).alias("n")).select(*_bounds(), "metric", "n")


def _over_threshold(events: DataFrame, threshold: int, window: str, lateness: str) -> DataFrame:
    counts = _windowed(events, window, lateness).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)
    return counts.select(*_bounds(), "n")


def failure_alerts(
    events: DataFrame, threshold: int = THRESHOLD, window: str = WINDOW, lateness: str = "10 minutes"
) -> DataFrame:
    """Windows with more unexpected failures than the threshold."""
    return _over_threshold(events.where(F.col("event") == FAILURE_EVENT), threshold, window, lateness)


def server_error_alerts(
    events: DataFrame, threshold: int = THRESHOLD, window: str = WINDOW, lateness: str = "10 minutes"
) -> DataFrame:
    """Windows with more server errors than the threshold."""
    return _over_threshold(events.where(F.col("status") >= 500), threshold, window, lateness)


def rejection_alerts(events: DataFrame, threshold: int, window: str = WINDOW, lateness: str = "10 minutes") -> DataFrame:
    """Windows with more rejected files than the threshold."""
    return _over_threshold(events.where(F.col("event") == REJECTION_EVENT), threshold, window, lateness)


def ops_series(events: DataFrame, window: str = WINDOW, lateness: str = "10 minutes") -> DataFrame:
    """Requests, server errors and the 95th percentile of the duration per window."""
    return (
        _windowed(events, window, lateness)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") >= 500).alias("errors"),
            F.percentile_approx("duration_ms", 0.95, 10_000).alias("p95_duration_ms"),
        )
        .select(*_bounds(), "requests", "errors", "p95_duration_ms")
    )


# --- the table that a windowed stream keeps ---------------------------------------------------------


def keep_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a windowed stream over all events that arrived; the folder at ``path`` gets every change of a window.

    In update mode a micro-batch brings only the windows it changed, and the state holds only windows that the watermark has not closed.
    The rows go to a folder per day of the window and micro-batch; a batch that is run again replaces its own folders.
    ``current_windows`` reads the latest row of each window.
    """

    def add(batch: DataFrame, epoch: int) -> None:
        _write(batch.withColumns({"day": F.to_date("window_start"), "epoch": F.lit(epoch).cast("long")}), path)

    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "epoch").parquet(path)


def current_windows(spark: SparkSession, path: str, schema: T.StructType, labels: tuple[str, ...] = ()) -> DataFrame:
    """The latest row of every window, and of every value of ``labels`` in it, from the folder of ``keep_windows``."""
    kept = spark.read.schema(_kept(schema)).parquet(path)
    keys = ["window_start", "window_end", *labels]
    rest = [f.name for f in schema if f.name not in keys]
    latest = kept.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("latest"))
    return latest.select(*[F.col(f.name if f.name in keys else f"latest.{f.name}") for f in schema])


def _kept(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("day", T.DateType()), T.StructField("epoch", T.LongType())])


def compact_windows(spark: SparkSession, path: str, schema: T.StructType, before: dt.date, labels: tuple[str, ...] = ()) -> None:
    """Keep one folder for each day before ``before``, whose windows are closed.

    The latest rows take the place of the day's last micro-batch first and the older ones go then, so readers, who look at the latest row of
    each window, find the same rows at any moment.
    """
    kept = spark.read.schema(_kept(schema)).parquet(path).where(F.col("day") < before)
    # One row per day.
    several = kept.groupBy("day").agg(F.max("epoch").alias("last"), F.count_distinct("epoch").alias("n")).where("n > 1").collect()
    for row in several:
        latest = current_windows(spark, path, schema, labels).where(F.to_date("window_start") == row.day)
        latest = materialize(latest, "compacted").withColumns({"day": F.lit(row.day), "epoch": F.lit(row["last"])})
        _write(latest, path)
        old = kept.where((F.col("day") == row.day) & (F.col("epoch") < row["last"])).select("epoch").distinct()
        for epoch in old.collect():
            delete_path(spark, f"{path}/day={row.day}/epoch={epoch.epoch}")
