"""Tables of the lake: parquet folders written by layer.

Two kinds of table share one address ``<layer>/<table>``:

* tables that are replaced whole get a fresh folder per write. It is written under a name that readers pass over and renamed when it is whole
  (and, in a build, when its tests have passed): readers find the old rows until then, and a write that fails leaves them alone.
* tables that grow by partitions (raw rows, logs) live in one folder. Their columns may grow too: the schema is kept with the table, in files
  of no rows below ``_schema`` which Spark's own merge of Parquet schemas reads, and rows are read by name, NULL where a file lacks a column.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, materialize

_VERSION = "v-"
_NEXT = "_next-"
_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def merged_schema(known: T.StructType | None, more: T.StructType) -> T.StructType:
    """``known`` with the columns that only ``more`` has, compared without case."""
    fields = list(known.fields) if known else []
    names = {f.name.lower() for f in fields}
    for field in more.fields:
        if field.name.lower() not in names:
            fields.append(T.StructField(field.name, field.dataType))
            names.add(field.name.lower())
    return T.StructType(fields)


class Lake:
    """Tables below one root folder, addressed as ``<layer>/<table>``.

    ``keep`` is how long a replaced version stays, for readers that began on it.
    """

    def __init__(self, spark: SparkSession, root: str, keep: dt.timedelta = dt.timedelta(hours=1)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self._schemas: dict[tuple[str, ...], T.StructType] = {}

    # --- places -----------------------------------------------------------------------------------

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _folder(self, path: str):
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(sc._jsc.hadoopConfiguration()), folder

    def _versions(self, layer: str, table: str) -> list[str]:
        """Names of the whole versions of a replaced table, oldest first."""
        fs, folder = self._folder(self.path(layer, table))
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        whole = [n for n in names if n.startswith(_VERSION) and fs.exists(self._folder(f"{folder}/{n}/_SUCCESS")[1])]
        return sorted(whole)

    def location(self, layer: str, table: str) -> str:
        """The folder whose rows are the table's now."""
        versions = self._versions(layer, table)
        return f"{self.path(layer, table)}/{versions[-1]}" if versions else self.path(layer, table)

    def exists(self, layer: str, table: str) -> bool:
        fs, folder = self._folder(self.location(layer, table))
        # A folder that holds versions only, none of them whole, is no table yet.
        return fs.exists(folder) and any(not s.getPath().getName().startswith((_VERSION, _NEXT, "_schema")) for s in fs.listStatus(folder))

    # --- reading ----------------------------------------------------------------------------------

    def schema(self, layer: str, table: str) -> T.StructType | None:
        """The columns kept with a growing table, None where none are."""
        kept = f"{self.path(layer, table)}/_schema"
        fs, folder = self._folder(kept)
        if not fs.exists(folder):
            return None
        # Folders are only ever added, so those of the same names hold the same columns.
        names = tuple(sorted(s.getPath().getName() for s in fs.listStatus(folder) if fs.exists(self._folder(f"{s.getPath()}/_SUCCESS")[1])))
        if names not in self._schemas:
            self._schemas[names] = self.spark.read.option("mergeSchema", "true").parquet(*[f"{kept}/{n}" for n in names]).schema
        return self._schemas[names]

    def read(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        """Read a table; with a schema, a table nobody wrote yet is empty.

        A column added later is NULL in the files written before.
        """
        kept = self.schema(layer, table)
        if kept is not None:
            schema = merged_schema(schema, kept)
        if schema is None:
            return self.spark.read.parquet(self.location(layer, table))
        if not self.exists(layer, table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.location(layer, table))

    def publish(self, layer: str, table: str, name: str) -> None:
        """Let ``name`` in the session's catalog show the current rows, for those who write SQL."""
        location = self.location(layer, table)
        if self.spark.catalog.tableExists(name):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.catalog.createTable(name, path=location, source="parquet")

    # --- tables that are replaced whole -----------------------------------------------------------

    def stage(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        day: str | None = None,
        cluster_by: tuple[str, ...] = (),
        spread_by: tuple[str, ...] = (),
    ) -> str:
        """Write the next version of a table beside the present one; the folder to ``switch`` to.

        ``day`` makes one folder per date (or other value); Spark rebalances the rows by it and splits a date that
        holds very many. Without ``day`` the rows are laid out in ranges of ``cluster_by``, and
        ``spread_by`` (the key) splits a cluster value that holds very many. Rows are sorted by
        ``cluster_by`` inside each file, so that readers can skip by min and max.
        """
        writer_options = {}
        if day:
            df = df.hint("rebalance", F.col(day))
            writer_options["partitionBy"] = day
            df = df.sortWithinPartitions(day, *cluster_by)
        elif cluster_by:
            df = df.repartitionByRange(*cluster_by, *spread_by).sortWithinPartitions(*cluster_by, *spread_by)
        fresh = f"{self.path(layer, table)}/{_NEXT}{uuid.uuid4().hex}"
        df.write.parquet(fresh, **writer_options)
        return fresh

    def switch(self, layer: str, table: str, staged: str) -> None:
        """Make a staged version the table; readers, the makers of the next version among them, keep the old one until then."""
        fs, source = self._folder(staged)
        _, target = self._folder(f"{self.path(layer, table)}/{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
        if not fs.rename(source, target):
            raise OSError(f"could not move {staged} to {target}")
        self._forget(layer, table)

    def overwrite(self, layer: str, table: str, df: DataFrame, **layout) -> None:
        """Replace a table, laid out as ``stage`` says."""
        self.switch(layer, table, self.stage(layer, table, df, **layout))

    def _forget(self, layer: str, table: str) -> None:
        """Remove versions that were replaced longer than ``keep`` ago."""
        versions = self._versions(layer, table)
        horizon = time.time_ns() - self.keep // dt.timedelta(microseconds=1) * 1000
        for old, newer in zip(versions, versions[1:], strict=False):
            if int(newer.removeprefix(_VERSION).split("-")[0]) < horizon:
                delete_path(self.spark, f"{self.path(layer, table)}/{old}")

    # --- tables that grow -------------------------------------------------------------------------

    def grow(self, layer: str, table: str, columns: T.StructType) -> T.StructType:
        """Keep columns with the table that it doesn't have yet; its schema afterwards."""
        known = self.schema(layer, table)
        wanted = merged_schema(known, columns)
        if known is None or len(wanted) > len(known):
            # Writers that add columns at the same time each add a folder.
            self.spark.createDataFrame([], wanted).write.parquet(f"{self.path(layer, table)}/_schema/{uuid.uuid4().hex}")
        return wanted

    def add_column(self, layer: str, table: str, name: str, kind: T.DataType) -> None:
        """Give a growing table one more column, NULL in the rows written before."""
        known = self.schema(layer, table)
        if known is None:
            known = self.read(layer, table).schema
        self.grow(layer, table, merged_schema(known, T.StructType([T.StructField(name, kind)])))

    def replace_partitions(self, layer: str, table: str, df: DataFrame, by: tuple[str, ...]) -> None:
        """Write ``df`` in place of the partitions it covers and leave the others alone.

        Repeating the same load replaces its own rows instead of adding them again. Columns of ``df`` that a growing
        table lacks are kept with it.
        """
        if self.schema(layer, table) is not None:
            spelled = {f.name.lower(): f.name for f in self.grow(layer, table, df.schema)}
            df = df.toDF(*[spelled[c.lower()] for c in df.columns])
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(
            self.location(layer, table)
        )

    def aside(self, layer: str, table: str) -> str:
        """A fresh folder on the store of a growing table that its readers pass over."""
        return f"{self.path(layer, table)}/{_NEXT}{uuid.uuid4().hex}"

    def put_partition(self, layer: str, table: str, aside: str, written: list[str], by: dict[str, str]) -> None:
        """Make what lies in the folders ``written``, below ``aside``, the partition ``by``, in place of what that held.

        The rows don't hold the partition columns. Files are renamed only: no row is written a second time.
        """
        escaped = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        fs, whole = self._folder(f"{aside}/whole")
        fs.mkdirs(whole)
        for folder in written:
            for status in fs.listStatus(self._folder(folder)[1]):
                name = status.getPath().getName()
                if not name.startswith(("_", ".")) and not fs.rename(status.getPath(), self._folder(f"{whole}/{name}")[1]):
                    raise OSError(f"could not move {status.getPath()}")
        _, target = self._folder("/".join([self.path(layer, table), *[f"{c}={escaped(v)}" for c, v in by.items()]]))
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(whole, target):
            raise OSError(f"could not move {whole} to {target}")

    def replace_values(self, layer: str, table: str, df: DataFrame, column: str, values: list) -> None:
        """Make ``df`` all rows of a partitioned table whose ``column`` is one of ``values`` (None is NULL)."""
        self.replace_partitions(layer, table, df, (column,))
        left = {row[column] for row in df.select(column).distinct().collect()}
        for value in set(values) - left:
            delete_path(self.spark, f"{self.location(layer, table)}/{column}={_HIVE_NULL if value is None else value}")

    def append(self, layer: str, table: str, df: DataFrame, by: tuple[str, ...]) -> None:
        """Add rows to a partitioned table."""
        df.write.mode("append").partitionBy(*by).parquet(self.path(layer, table))

    def drop_partitions(self, layer: str, table: str, column: str, value: str, apart_from: str | None = None) -> None:
        """Remove the partitions of one value of the innermost partition column, but for those below ``apart_from``."""
        fs, folder = self._folder(self.path(layer, table))
        if not fs.exists(folder):
            return
        name = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
        for outer in fs.listStatus(folder):
            place = f"{outer.getPath()}/{column}={name}"
            if outer.isDirectory() and outer.getPath().getName() != apart_from and fs.exists(self._folder(place)[1]):
                delete_path(self.spark, place)

    def delete_batches(
        self, layer: str, table: str, batch_ids: list[str], by: tuple[str, ...], schema: T.StructType
    ) -> None:
        """Remove all rows of some batches; only the folders that hold them are rewritten.

        Folders are told apart by the paths of their files, so any partition value will do, NULL and escaped ones too.
        """
        if not self.exists(layer, table):
            return
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "")
        df = self.read(layer, table, schema).withColumn("_folder", folder)
        doomed = F.coalesce(F.col("batch_id").isin(batch_ids), F.lit(False))
        state = df.groupBy("_folder").agg(F.count_if(doomed).alias("gone"), F.count_if(~doomed).alias("kept"))
        touched = materialize(state.where("gone > 0"), "touched")
        mixed = touched.where("kept > 0").select("_folder")
        if not mixed.isEmpty():
            # Written aside first: the rewrite reads the files that it replaces.
            left = materialize(df.join(mixed, "_folder", "left_semi").where(~doomed).drop("_folder"), "left")
            self.replace_partitions(layer, table, left, by)
        for row in touched.where("kept = 0").toLocalIterator():
            delete_path(self.spark, self._decoded(row["_folder"]))

    def _decoded(self, uri: str) -> str:
        """The Hadoop path of a percent-encoded file URI."""
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union of logs of different ages; a column one of them lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
