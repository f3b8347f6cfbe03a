"""Session set-up and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The ingest clock is UTC, so every date taken from a timestamp must be a UTC date.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="bazaarlake-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


# Per thread, so that a scope that ends in one thread leaves the tables of another alone.
_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    scopes = _open_scopes.get()
    if scopes:
        scopes[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables written inside the block when it ends.

    For jobs that have written their result by then; a lazy result may still read its scratch tables.
    """
    paths: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), paths))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in paths:
            delete_path(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nobody holds any more.

    Spark deletes them once the driver's garbage collector has met the plans, which with a heap that is seldom full may be very late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the same intermediate result. A written table keeps column
    pruning and size statistics and survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
