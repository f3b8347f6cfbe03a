import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlake.operators import checks, joins
from bazaarlake.operators.dedup import latest_per_key
from bazaarlake.operators.rank import global_rank

DAY = dt.datetime(2024, 1, 1)


def test_latest_row_wins_and_ties_are_repeatable(spark, rows):
    data = [
        ("a", DAY, "r1", "x"),
        ("a", DAY + dt.timedelta(1), "r1", "y"),
        ("b", None, "r9", "old"),
        ("b", DAY, "r1", "new"),
        ("c", DAY, "r1", "p"),
        ("c", DAY, "r2", "q"),
        ("d", DAY, "r1", "m"),
        ("d", DAY, "r1", "n"),
        (None, DAY, "r1", "k"),
        (None, DAY, "r2", "l"),
    ]
    df = spark.createDataFrame(data, "id string, ingestion_timestamp timestamp, run_id string, v string")
    expected = sorted([("a", "y"), ("b", "new"), ("c", "q"), ("d", "n"), (None, "l")], key=repr)
    for shuffled in (df, df.orderBy(F.desc("v")), df.repartition(5)):
        assert rows(latest_per_key(shuffled, ["id"]), "id", "v") == expected


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", DAY), ("a", None)], "k string, ingestion_timestamp timestamp")
    plan = latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    ("kind", "ranges"),
    [("decimal(28,9)", None), ("decimal(28,9)", 1), ("decimal(28,9)", 40), ("string", 7), ("double", 40), ("timestamp_ntz", 1000)],
)
def test_global_rank_equals_plain_rank(spark, rows, kind, ranges):
    # A third of the rows share one value, some are NULL, and there are many ties.
    value = F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") * 7919) % 400)
    if kind == "timestamp_ntz":
        cast = F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(v as int))")
    else:
        cast = F.col("v").cast(kind)
    df = spark.range(3000).select("id", value.alias("v")).withColumn("v", cast)
    plain = df.withColumn("rank", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert rows(global_rank(df, "v", ranges=ranges)) == rows(plain)


def test_global_rank_of_few_or_no_values(spark, rows):
    empty = spark.createDataFrame([], "id long, v double")
    assert rows(global_rank(empty, "v")) == []
    nulls = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert rows(global_rank(nulls, "v")) == [(1, None, 1), (2, None, 1)]
    same = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "id long, v double")
    assert rows(global_rank(same, "v"), "id", "rank") == [(1, 1), (2, 1), (3, 3)]
    odd = spark.createDataFrame([(1, float("nan")), (2, 0.0), (3, -0.0), (4, float("-inf")), (5, None)], "id long, v double")
    assert rows(global_rank(odd, "v", ranges=9), "id", "rank") == [(1, 1), (2, 2), (3, 2), (4, 4), (5, 5)]
    texts = spark.createDataFrame([(1, "10"), (2, "9"), (3, "é"), (4, "")], "id long, v string")
    assert rows(global_rank(texts, "v"), "id", "rank") == [(1, 3), (2, 2), (3, 1), (4, 4)]
    with pytest.raises(TypeError, match="no order"):
        global_rank(spark.createDataFrame([(1, {"a": 1})], "id long, v map<string,int>"), "v")


def test_global_rank_spreads_a_hot_value(spark):
    """One value in nearly all rows lies in several ranges of the one table that is written."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("v"))
    ranked = global_rank(df, "v", ranges=8)
    assert ranked.where("v = 1").agg(F.min("rank"), F.max("rank")).first() == (2000, 2000)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [rank" in plan and "RepartitionByExpression" not in plan


def test_lookup_join_with_hot_key(spark, rows):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("string")).alias("k"),
        "id",
    )
    right = left.where("k is not null and (k = 'hot' or id < 500)").select("k").distinct().withColumn("name", F.upper("k"))
    assert rows(joins.lookup_join(left, right, "k")) == rows(left.join(right, "k", "left"))


def test_hot_key_is_spread(spark, tmp_path):
    """Adaptive execution splits the rows of a hot key over tasks, as both sides are plain exchanges."""
    spark.range(0, 40_000, 1, 8).select(F.lit("hot").alias("k"), F.uuid().alias("u")).write.parquet(str(tmp_path / "left"))
    spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, n int").write.parquet(str(tmp_path / "right"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        joined = joins.lookup_join(spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right")), "k")
        sizes = Counter(r.part for r in joined.withColumn("part", F.spark_partition_id()).collect())
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert sizes.total() == 40_000 and max(sizes.values()) < 20_000


def test_missing_parents(spark, rows):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), (None,)], "id string")
    assert rows(joins.missing_parents(child, "k", parent, "id")) == [("a", 2)]


def test_checks_count_failures(spark, rows):
    df = spark.createDataFrame(
        [("a", -1, "x"), ("a", 2, "y"), (None, None, "bad"), (None, 3, "worse"), ("c", 3, "bad")],
        "id string, n int, s string",
    )
    parent = spark.createDataFrame([("c",)], "id string")
    tests = checks.TableTests(
        not_null=("id", "n"),
        unique=("id",),
        unique_together=(("id", "n"), ("s",)),
        accepted={"s": ("x", "y")},
        non_negative=("n",),
        parents={"id": ("p", "id")},
    )
    found = checks.run_tests({"t": tests}, {"t": df, "p": parent}.__getitem__, warn_only=(("t", "unique", "id"),))
    assert rows(found, "test", "column_name", "failures", "status") == sorted(
        [
            ("not_null", "id", 2, "ERROR"),
            ("not_null", "n", 1, "ERROR"),
            ("unique", "id", 1, "WARN"),
            ("unique_together", "id,n", 0, "PASS"),
            ("unique_together", "s", 1, "ERROR"),
            ("accepted_values", "s", 2, "ERROR"),
            ("non_negative", "n", 1, "ERROR"),
            ("relationships", "id", 2, "ERROR"),
        ],
        key=repr,
    )
    assert rows(checks.summarize(found, skipped=1)) == [(1, 1, 6, 1, 9)]


def test_quarantine(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None)], "n int, s string")
    good, bad = checks.quarantine(df, {"n": F.col("n") >= 0, "s": F.col("s").isNotNull()})
    assert rows(good) == [(1, "a")]
    assert rows(bad) == sorted([(None, "b", "ROW", "n"), (-1, None, "ROW", "n; s")], key=repr)


def test_freshness(spark, rows):
    df = spark.createDataFrame([(DAY,), (None,)], "ingestion_timestamp timestamp")
    now = F.lit(DAY + dt.timedelta(hours=5))
    assert rows(checks.freshness({"t": df}, now, 4), "table_name", "status") == [("t", "WARN")]
    assert rows(checks.freshness({"t": df}, now, 6), "table_name", "status") == [("t", "PASS")]
