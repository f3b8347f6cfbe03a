import datetime as dt

from pyspark.sql import functions as F

from bazaarlake.plans import ingest
from bazaarlake.sources import sample
from bazaarlake.streaming import events as ev
from bazaarlake.streaming.ingest import ingest_available
from test_ingest import FILES, GOOD, put

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 2, 3, 4, 5)


def test_stream_counts_equal_batch_counts(spark, tmp_path, rows):
    batch = sample.pipeline_events(spark, SF)
    # Lateness covers the whole sample, so no row is dropped whatever the order of the files.
    lateness = "40 days"
    closing = batch.limit(1).select(
        F.lit(dt.datetime(2030, 1, 1)).alias("timestamp"),
        F.lit("pipeline_completed").alias("event"),
        F.lit(500).cast("bigint").alias("status"),
        "run_id",
        "batch_id",
        "duration_ms",
    )
    source = str(tmp_path / "events")
    batch.repartition(3).write.parquet(source)
    for name, build in {
        "counts": lambda e: ev.event_counts(e, lateness=lateness),
        "errors": lambda e: ev.server_error_alerts(e, lateness=lateness),
        "ops": lambda e: ev.ops_series(e, lateness=lateness),
    }.items():
        target, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")

        def run():
            stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(source)
            query = (
                build(stream)
                .writeStream.outputMode("append")
                .format("parquet")
                .option("path", target)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()

        run()
        closing.write.mode("append").parquet(source)
        run()
        final = spark.read.parquet(target).where("window_start < timestamp'2029-01-01'")
        assert rows(final) == rows(build(batch)), name


def test_state_shrinks_and_the_table_is_right(spark, tmp_path, rows):
    """Several micro-batches in the order of time: closed windows leave the state, and the table holds the latest row of each."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("events", "windows", "checkpoint"))
    batch = sample.pipeline_events(spark, SF).where("event is not null and timestamp is not null").cache()
    days = [r.day for r in batch.select(F.to_date("timestamp").alias("day")).distinct().orderBy("day").collect()]
    for k, day in enumerate([*days[:6], days[5] + dt.timedelta(days=40)]):
        part = batch.where(F.to_date("timestamp") == day)
        if k == 6:
            part = batch.limit(1).withColumns({"timestamp": F.lit(dt.datetime(2030, 1, 1)), "event": F.lit("pipeline_completed")})
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(source)
    counts = ev.event_counts(stream)
    query = ev.keep_windows(counts, target, checkpoint)
    query.awaitTermination()
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert len(held) >= 7 and max(held) > held[-1] and held[-1] <= 2

    expected = rows(ev.event_counts(batch.where(F.to_date("timestamp").isin(days[:6]))))
    now = ev.current_windows(spark, target, counts.schema, ("metric",)).where("window_start < timestamp'2029-01-01'")
    assert rows(now) == expected
    ev.compact_windows(spark, target, counts.schema, dt.date(2029, 1, 1), ("metric",))
    assert rows(now) == expected
    assert all(len(list(folder.glob("epoch=*"))) == 1 for folder in (tmp_path / "windows").glob("day=*"))
    # A window that gets more events later has its newest row; a batch that runs again replaces its folders.
    first = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5), "m", 1)], counts.schema)
    for epoch, n in ((0, 1), (1, 5), (1, 5)):
        rows_of = first.withColumns({"n": F.lit(n).cast("long"), "day": F.lit(dt.date(2024, 1, 1)), "epoch": F.lit(epoch).cast("long")})
        ev._write(rows_of, str(tmp_path / "again"))
    assert [r.n for r in ev.current_windows(spark, str(tmp_path / "again"), counts.schema, ("metric",)).collect()] == [5]


def test_alert_threshold(spark, rows):
    data = [(dt.datetime(2024, 1, 1, 0, m), e, 400) for m, e in [(0, "file_rejected"), (4, "file_rejected"), (6, "file_rejected")]]
    df = spark.createDataFrame(data, "timestamp timestamp, event string, status long")
    assert [r.n for r in ev.rejection_alerts(df, threshold=1).collect()] == [2]
    assert ev.failure_alerts(df).count() == 0


def test_incremental_ingest(lake, tmp_path, rows):
    root, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    put(root, "orders", "b1", "a.csv", GOOD)
    put(root, "sellers", "b2", "s.csv", FILES["sellers"])
    put(root, "orders", "b3", "empty.csv", "")
    ingest_available(lake, root, checkpoint, clock=lambda: AT)
    assert ingest.read_bronze(lake, "orders").count() == 2
    uploads = ingest.read_log(lake, "file_upload_log")
    assert rows(uploads, "batch_id", "upload_status") == [("b1", "SUCCESS"), ("b2", "SUCCESS"), ("b3", "FAILED")]

    # A second run sees only the new files.
    put(root, "orders", "b4", "copy.csv", GOOD)
    put(root, "orders", "b5", "more.csv", GOOD.replace("c1", "c7"))
    refreshed = []
    ingest_available(
        lake, root, checkpoint, clock=lambda: AT + dt.timedelta(1), after_batch=lambda lk: refreshed.append(lk)
    )
    uploads = ingest.read_log(lake, "file_upload_log")
    assert rows(uploads.where("batch_id > 'b3'"), "batch_id", "upload_status") == [("b4", "DUPLICATE"), ("b5", "SUCCESS")]
    assert ingest.read_bronze(lake, "orders").count() == 4
    assert refreshed == [lake]
