import datetime as dt
import glob
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.contracts import AUDIT_LOGS
from bazaarlake.sources.tables import union_by_name


def test_day_partitions_and_pruning(lake, rows):
    df = lake.spark.range(100).select(
        F.when(F.col("id") < 90, F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 3).cast("int"))).alias("day"),
        "id",
    )
    lake.overwrite("gold", "t", df, day="day", cluster_by=("id",))
    folders = {p.rsplit("day=", 1)[1] for p in glob.glob(lake.location("gold", "t") + "/day=*")}
    assert folders == {"2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"}
    back = lake.read("gold", "t")
    assert rows(back.select("day", "id")) == rows(df)
    plan = back.where("day = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    lake.overwrite("gold", "t", df.where("id < 3"), day="day")
    assert lake.read("gold", "t").count() == 3
    # A table may be rewritten from itself.
    lake.overwrite("gold", "t", lake.read("gold", "t").where("id < 2"))
    assert lake.read("gold", "t").count() == 2


def test_clustered_table(lake, rows):
    df = lake.spark.range(1000).select((F.col("id") % 7).alias("state"), "id")
    lake.overwrite("gold", "c", df, cluster_by=("state",), spread_by=("id",))
    assert rows(lake.read("gold", "c")) == rows(df)


def test_hot_day_is_split_on_write(lake):
    spark = lake.spark
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(200_000).select(F.lit(dt.date(2024, 1, 1)).alias("day"), "id", F.uuid().alias("u"))
        lake.overwrite("gold", "hot", df, day="day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(lake.location("gold", "hot") + "/day=2024-01-01/*.parquet")) > 1


def test_replace_partitions(lake, rows):
    spark = lake.spark
    make = lambda *r: spark.createDataFrame(list(r), "v int, part string")
    lake.replace_partitions("audit", "log", make((1, "a"), (2, "b")), ("part",))
    lake.replace_partitions("audit", "log", make((9, "b")), ("part",))
    assert rows(lake.read("audit", "log"), "part", "v") == [("a", 1), ("b", 9)]


def test_missing_log_is_empty_and_old_files_lack_new_columns(lake, rows):
    schema = T.StructType([*AUDIT_LOGS["file_upload_log"].fields])
    assert lake.read("audit", "file_upload_log", schema).count() == 0
    old = lake.spark.createDataFrame([("u1",)], "upload_id string")
    old.write.parquet(lake.path("audit", "file_upload_log"))
    assert rows(lake.read("audit", "file_upload_log", schema), "upload_id", "source_file_name") == [("u1", None)]
    lake.add_column("audit", "file_upload_log", "source_file_name", T.StringType())
    assert rows(lake.read("audit", "file_upload_log")) == [("u1", None)]
    new = lake.spark.createDataFrame([("u2", "f.csv")], "upload_id string, source_file_name string")
    assert rows(union_by_name(old, new)) == [("u1", None), ("u2", "f.csv")]


def test_scratch_scopes_are_per_thread(spark):
    import os
    import threading

    from bazaarlake.session import materialize, scratch_scope

    opened, close, paths = threading.Event(), threading.Event(), []

    def other():
        with scratch_scope(spark):
            paths.append(materialize(spark.range(3), "other").inputFiles()[0].removeprefix("file:"))
            opened.set()
            close.wait(60)

    thread = threading.Thread(target=other)
    with scratch_scope(spark):
        thread.start()
        opened.wait(60)
    assert os.path.exists(paths[0].replace("file://", ""))
    close.set()
    thread.join()
    assert not os.path.exists(paths[0].replace("file://", ""))


def test_readers_always_find_a_whole_version(lake):
    """20 overwrites while another thread reads: every read sees all rows of one version."""
    spark = lake.spark
    lake.overwrite("gold", "w", spark.range(1000).select(F.lit(0).alias("version"), "id"))
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                found = lake.read("gold", "w").groupBy("version").count().collect()
                seen.append([(r.version, r["count"]) for r in found])
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 21):
        lake.overwrite("gold", "w", spark.range(1000).select(F.lit(k).alias("version"), "id"))
    stop.set()
    reader.join()
    assert errors == [] and len(seen) > 1
    assert all(len(s) == 1 and s[0][1] == 1000 for s in seen)
    assert [s[0][0] for s in seen] == sorted(s[0][0] for s in seen)


def test_failed_write_leaves_the_old_version(lake, rows):
    spark = lake.spark
    lake.overwrite("gold", "f", spark.range(3))
    with pytest.raises(Exception, match="halfway"):
        lake.overwrite("gold", "f", spark.range(100).select(F.when(F.col("id") < 50, F.col("id")).otherwise(F.raise_error(F.lit("halfway")).cast("long")).alias("id")))
    assert rows(lake.read("gold", "f")) == [(0,), (1,), (2,)]
    # A folder that was never finished is no version either.
    os.makedirs(lake.path("gold", "f") + "/v-99999999999999999999-dead")
    assert lake.read("gold", "f").count() == 3
    assert not lake.exists("gold", "nothing")


def test_old_versions_go(lake):
    lake.keep = dt.timedelta(0)
    for k in range(3):
        lake.overwrite("gold", "k", lake.spark.range(k + 1))
    assert len(glob.glob(lake.path("gold", "k") + "/v-*")) == 1
    assert lake.read("gold", "k").count() == 3


def test_catalog_table_follows_the_versions(lake):
    spark = lake.spark
    for k in (2, 5):
        lake.overwrite("gold", "p", spark.range(k))
        lake.publish("gold", "p", "published_numbers")
        assert spark.sql("select count(*) as n from published_numbers").first().n == k
    spark.sql("drop table published_numbers")


def test_columns_grow(lake, rows):
    spark = lake.spark
    lake.grow("bronze", "g", T.StructType([T.StructField("a", T.StringType()), T.StructField("part", T.StringType())]))
    lake.replace_partitions("bronze", "g", spark.createDataFrame([("1", "x")], "a string, part string"), ("part",))
    lake.replace_partitions("bronze", "g", spark.createDataFrame([("2", "y", "5")], "a string, part string, Rating string"), ("part",))
    lake.replace_partitions("bronze", "g", spark.createDataFrame([("3", "z", "4")], "A string, part string, rating string"), ("part",))
    assert rows(lake.read("bronze", "g"), "a", "part", "Rating") == [("1", "x", None), ("2", "y", "5"), ("3", "z", "4")]
    lake.add_column("bronze", "g", "score", T.DoubleType())
    assert lake.read("bronze", "g").schema["score"].dataType == T.DoubleType()
    assert rows(lake.read("bronze", "g"), "a", "score") == [("1", None), ("2", None), ("3", None)]


def test_delete_batches_of_any_partition_value(lake, rows):
    """Partition values that are escaped in paths, NULL ones, and folders that go as a whole."""
    spark = lake.spark
    data = [(1, "keep", "a:b"), (2, "drop", "a:b"), (3, "drop", "c d%e"), (4, "keep", None), (5, "drop", None), (6, None, "f/g"), (7, "drop", "h=i")]
    df = spark.createDataFrame(data, "v int, batch_id string, part string")
    lake.replace_partitions("bronze", "d", df, ("part",))
    lake.delete_batches("bronze", "d", ["drop"], ("part",), df.schema)
    assert rows(lake.read("bronze", "d", df.schema), "v", "part") == [(1, "a:b"), (4, None), (6, "f/g")]
    lake.delete_batches("bronze", "d", ["drop", "none"], ("part",), df.schema)
    assert lake.read("bronze", "d", df.schema).count() == 3
