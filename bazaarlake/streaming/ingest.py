"""Incremental ingest: new files of the landing zone, in micro-batches of a bounded number of files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import ingest
from ..plans.ingest import IngestOptions
from ..session import scratch_scope
from ..sources import landing
from ..sources.tables import Lake


def start_ingest(
    lake: Lake,
    root: str,
    checkpoint: str,
    name: str = "stream",
    options: IngestOptions = IngestOptions(),
    after_batch: Callable[[Lake], object] | None = None,
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
) -> StreamingQuery:
    """Process all files that arrived since the last run, then stop (``availableNow``).

    The checkpoint remembers which files were seen; the batch number is part of the ingest id, so a
    replayed batch replaces its own rows. ``after_batch`` may refresh the layers above.
    """
    spark = lake.spark
    paths = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", options.max_files)
        .load(f"{root}/tmp")
        .select(landing.relative(F.col("path"), root).alias("tmp_file_path"))
    )

    def process(batch: DataFrame, epoch: int) -> None:
        new = landing.collect_requests(landing.describe(batch))
        if new:
            with scratch_scope(spark):
                ingest.ingest_batch(lake, root, new, f"{name}-{epoch}", clock(), options)
            if after_batch:
                after_batch(lake)

    return (
        paths.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(lake: Lake, root: str, checkpoint: str, name: str = "stream", **options) -> None:
    """One scheduled run: the stream, then the files it cannot see because they hold no bytes."""
    start_ingest(lake, root, checkpoint, name, **options).awaitTermination()
    clock = options.get("clock") or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    settings = options.get("options") or IngestOptions()
    stamp = clock()
    with scratch_scope(lake.spark):
        ingest.ingest_landing(lake, root, f"{name}-left-{stamp:%Y%m%d%H%M%S}", stamp, settings)
