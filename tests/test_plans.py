"""Hand-made rows for the cases real data rarely shows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import registry
from bazaarlake.contracts import AUDIT_LOGS, ENTITIES, bronze_schema
from bazaarlake.plans import gold, marts, quality, silver
from bazaarlake.session import materialize
from bazaarlake.sources import sample

DAY = dt.datetime(2024, 1, 1)


def bronze(spark, entity, *rows_):
    """Raw rows from dictionaries; lineage that is not given gets a default."""
    schema = bronze_schema(entity)
    defaults = {"run_id": "r", "batch_id": "b", "load_date": "2024-01-01", "ingestion_timestamp": DAY}
    return spark.createDataFrame([tuple({**defaults, **r}.get(f.name) for f in schema) for r in rows_], schema)


def orders(spark, *rows_):
    return silver.silver_orders(bronze(spark, "orders", *rows_))


def test_declared_tests_add_up():
    kinds = ("not_null", "unique", "accepted", "non_negative", "parents", "unique_together")

    def counts(tests):
        return [sum(len(getattr(t, k)) for t in tests.values()) for k in kinds]

    assert counts(quality.SILVER_TESTS) == [27, 4, 2, 8, 4, 2]
    assert counts(quality.GOLD_TESTS) == [28, 9, 2, 9, 7, 0]
    assert sum(t.count for t in [*quality.SILVER_TESTS.values(), *quality.GOLD_TESTS.values()]) == 102


@pytest.mark.parametrize("entity", list(ENTITIES))
def test_silver_schema(spark, entity):
    df = silver.trusted(entity, spark.createDataFrame([], bronze_schema(entity)))
    assert df.columns[: len(ENTITIES[entity].fields)] == [f.target for f in ENTITIES[entity].fields]
    assert df.columns[-2:] == ["load_date", "ingestion_timestamp"]
    kinds = {f.name: f.dataType for f in df.schema}
    assert isinstance(kinds["load_date"], T.DateType)


def test_silver_order_items_filters_on_raw_text(spark, rows):
    good = {"order_id": "o", "order_item_id": "1", "product_id": "p", "seller_id": "s", "price": "1.5"}
    df = silver.silver_order_items(
        bronze(
            spark,
            "order_items",
            good,
            {**good, "order_item_id": "x"},
            {**good, "order_item_id": "40.0"},
            {**good, "order_item_id": None},
            {**good, "order_id": " "},
            {**good, "product_id": ""},
            {**good, "seller_id": None},
            {**good, "order_id": " o"},
        )
    )
    # Numbers that cannot be read collapse into one row; keys are not trimmed.
    assert rows(df, "order_id", "order_item_id") == sorted([("o", 1), ("o", None), (" o", 1)], key=repr)


def test_blank_customer_stays_on_orders(spark, rows):
    df = orders(spark, {"order_id": "1", "customer_id": " "}, {"order_id": "\t"}, {"order_id": None})
    assert rows(df, "order_id", "customer_id") == [("1", " ")]


def test_dim_date_default_bounds(spark):
    df = gold.dim_date(spark)
    assert df.count() == 4018
    first = df.orderBy("date_key").first()
    assert (first.month_name, first.day_name, first.week_of_year, first.day_of_week) == ("January", "Friday", 0, 6)
    assert first.is_weekend is False


def test_dim_customer_adds_unknown_customers_once(spark, rows):
    customers = silver.silver_customers(bronze(spark, "customers", {"customer_id": "a", "customer_state": " sp "}))
    seen = [{"order_id": str(i), "customer_id": c} for i, c in enumerate(["a", "b", "b", None])]
    dim = gold.dim_customer(customers, orders(spark, *seen), dt.datetime(2025, 1, 1))
    assert rows(dim, "customer_key", "customer_state", F.col("ingestion_timestamp").cast("string")) == sorted(
        [("a", "SP", "2024-01-01 00:00:00"), ("b", None, "2025-01-01 00:00:00")], key=repr
    )
    plan = dim._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_fact_orders_edges(spark, rows):
    base = {"customer_id": "c", "order_purchase_timestamp": "2024-01-01 23:00:00"}
    estimate = {"order_estimated_delivery_date": "2024-01-05"}
    o = orders(
        spark,
        {"order_id": "late", **base, **estimate, "order_delivered_customer_date": "2024-01-05 00:00:01"},
        {"order_id": "on_time", **base, **estimate, "order_delivered_customer_date": "2024-01-05"},
        {"order_id": "open", **base, **estimate},
        {"order_id": "no_estimate", **base, "order_delivered_customer_date": "2024-01-02 01:00:00"},
        {"order_id": "no_purchase", "customer_id": "c", "order_delivered_customer_date": "2024-01-02"},
    )
    item = {"order_id": "late", "product_id": "p", "seller_id": "s", "price": "10", "freight_value": "1"}
    items = silver.silver_order_items(
        bronze(
            spark, "order_items", {**item, "order_item_id": "1"}, {**item, "order_item_id": "2", "freight_value": "?"}
        )
    )
    pays = silver.silver_payments(
        bronze(spark, "payments", {"order_id": "late", "payment_sequential": "1", "payment_value": "bad"})
    )
    fact = gold.fact_orders(o, items, pays)
    assert rows(fact, "order_id", "is_late_delivery", "delivery_days") == sorted(
        [
            ("late", True, 4),
            ("on_time", False, 4),
            ("open", False, None),
            ("no_estimate", False, 1),
            ("no_purchase", False, None),
        ],
        key=repr,
    )
    late = fact.where("order_id = 'late'").first()
    assert (late.total_order_items, late.item_revenue, late.freight_revenue) == (2, Decimal(20), Decimal(1))
    # A sum over price + freight leaves out the row whose freight is missing.
    assert late.gross_order_value == Decimal(11)
    assert (late.payment_count, late.total_payment_value) == (1, Decimal(0))
    bare = fact.where("order_id = 'open'").first()
    assert (bare.total_order_items, bare.gross_order_value, bare.payment_count) == (0, Decimal(0), 0)


def test_rfm_segments(spark, rows):
    schema = "customer_id string, order_id string, order_purchase_date date, gross_order_value decimal(38,9)"
    data, last = [], dt.date(2024, 12, 31)

    def add(customer, orders_, money, days):
        for i in range(orders_):
            data.append((customer, f"{customer}{i}", last - dt.timedelta(days), money and Decimal(money) / orders_))

    add("champion", 5, 1000, 0)
    add("loyal", 3, 10, 30)
    add("loyal_poor", 5, 999, 31)
    add("high", 1, 500, 200)
    add("churn", 1, 1, 181)
    add("regular", 1, 1, 180)
    add("no_money", 1, None, 90)
    data.append(("undated", "u", None, Decimal(9)))
    fact = spark.createDataFrame(data, schema)
    dim = spark.createDataFrame(
        [("champion", "p", "city", "ST")],
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
    )
    mart = marts.mart_customer_rfm(fact, dim)
    assert rows(mart, "customer_id", "recency_segment", "customer_segment") == sorted(
        [
            ("champion", "recent", "champion"),
            ("loyal", "recent", "loyal"),
            ("loyal_poor", "warm", "loyal"),
            ("high", "dormant", "high_value"),
            ("churn", "dormant", "churn_risk"),
            ("regular", "at_risk", "regular"),
            ("no_money", "warm", "regular"),
        ]
    )


def test_sales_mart_ratio(spark, rows):
    items = spark.createDataFrame(
        [
            ("p", "1", dt.date(2024, 1, 1), Decimal(1), Decimal(0), Decimal(1)),
            ("p", "2", dt.date(2024, 1, 1), Decimal(1), Decimal(0), Decimal(1)),
            ("q", "3", dt.date(2024, 1, 1), Decimal(1), Decimal(0), Decimal(1)),
            ("q", "3", dt.date(2024, 1, 1), None, None, None),
            ("q", "4", None, Decimal(1), Decimal(0), Decimal(1)),
            ("p", "5", dt.date(2024, 1, 2), None, None, None),
        ],
        "product_id string, order_id string, order_purchase_date date, item_revenue decimal(28,9), "
        "freight_value decimal(28,9), gross_item_value decimal(29,9)",
    ).withColumn("order_item_id", F.lit(1))
    products = spark.createDataFrame([("p", "toys")], "product_id string, product_category_name string")
    mart = marts.mart_sales_performance(items, products)
    got = rows(mart, F.dayofmonth("order_purchase_date"), "product_category_name", "total_orders", "average_order_value")
    assert got == sorted([(1, "toys", 2, Decimal(1)), (1, None, 1, Decimal(1)), (2, "toys", 1, None)], key=repr)
    thirds = marts.mart_sales_performance(items.withColumn("gross_item_value", F.lit(Decimal("0.5"))), products)
    assert str(thirds.schema["average_order_value"].dataType) == "DecimalType(38,9)"


def test_quality_mart_keeps_undated_rows_apart(spark):
    def log(name, *stamps):
        schema = AUDIT_LOGS[name]
        clock = "start_time" if name == "pipeline_run_log" else "created_at"
        return spark.createDataFrame([tuple(s if f.name == clock else None for f in schema) for s in stamps], schema)

    mart = marts.mart_pipeline_quality(
        log("pipeline_run_log", DAY, None),
        log("data_quality_log", DAY, None),
        log("rejected_records", DAY + dt.timedelta(1)),
        log("file_upload_log", DAY + dt.timedelta(1), None),
    )
    by_day = {}
    for row in mart.collect():
        by_day.setdefault(row.run_date, []).append(row)
    assert len(by_day[None]) == 3
    first, second = by_day[dt.date(2024, 1, 1)], by_day[dt.date(2024, 1, 2)]
    assert [(r.pipeline_steps, r.total_quality_checks, r.rejected_file_count) for r in first] == [(1, 1, 0)]
    assert [(r.rejected_file_count, r.total_file_uploads) for r in second] == [(1, 1)]


def test_hot_order_is_split_at_run_time(spark, tmp_path):
    """On written tables Spark itself splits the partition of an order with very many lines."""
    lines = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").alias("order_item_id"),
        F.uuid().alias("product_id"),
        *[F.lit("x").alias(c) for c in ("seller_id", "batch_id", "run_id", "gcs_uri", "file_hash", "source_system")],
        F.lit("f").alias("source_file_name"),
        F.lit(DAY).alias("shipping_limit_date"),
        F.lit(Decimal(1)).cast("decimal(28,9)").alias("price"),
        F.lit(Decimal(1)).cast("decimal(28,9)").alias("freight_value"),
        F.lit(DAY.date()).alias("load_date"),
        F.lit(DAY).alias("ingestion_timestamp"),
    )
    lines.write.parquet(str(tmp_path / "items"))
    lines.select(
        "order_id", F.uuid().alias("customer_id"), F.lit("s").alias("order_status"), F.lit(DAY).alias("order_purchase_timestamp")
    ).dropDuplicates(["order_id"]).write.parquet(str(tmp_path / "orders"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items, orders_ = spark.read.parquet(str(tmp_path / "items")), spark.read.parquet(str(tmp_path / "orders"))
        fact = gold.fact_order_items(items, orders_)
        assert len(fact.collect()) == 60_000
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan


def test_large_sample_tables_are_dealt_to_more_tasks_than_cores(spark, rows, tmp_path, monkeypatch):
    spark.range(90).selectExpr("id as a", "id % 7 as b").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    few = sample.read_spread(spark, str(tmp_path), "orders", "a", "b")
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sample, "ROWS_PER_TASK", 3, raising=False)
    many = sample.read_spread(spark, str(tmp_path), "orders", "a", "b")
    assert many.rdd.getNumPartitions() == 30
    assert rows(many) == rows(few) == sorted(((i, i % 7) for i in range(90)), key=repr)


def test_gold_tests_deduplicate_each_raw_table_once(spark, monkeypatch):
    raw = {e: bronze(spark, e, {c: "1" for c in ENTITIES[e].required_columns}) for e in ENTITIES}
    for e in ENTITIES:
        monkeypatch.setitem(sample.BRONZE, e, lambda spark, sf_dir, e=e: raw[e])
    deduplicated = []

    def recorded(df, name="step"):
        if "row_number()" in df._jdf.queryExecution().analyzed().toString():
            deduplicated.append(name)
        return materialize(df, name)

    monkeypatch.setattr(registry, "materialize", recorded)
    registry.QUERIES["dq_gold_results"](spark, "unused")
    assert sorted(deduplicated) == sorted(f"silver_{e}" for e in ENTITIES)
