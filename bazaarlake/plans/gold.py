"""Star schema: four dimensions and three facts over the trusted tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar
from ..operators.joins import lookup_join

# Bounds of the calendar.
CALENDAR_START = dt.date(2016, 1, 1)
CALENDAR_END = dt.date(2026, 12, 31)


def _calendar(days: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return days.select(
        d.alias("date_key"),
        d,
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        calendar.week_of_year(d).alias("week_of_year"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        calendar.is_weekend(d).alias("is_weekend"),
    )


def _every_day(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date_day")


def dim_date(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day between two dates."""
    return _calendar(spark.range(1).select(_every_day(F.lit(start), F.lit(end))))


def dim_date_covering(orders: DataFrame) -> DataFrame:
    """One row per day of every year in which an order was placed."""
    day = F.to_date("order_purchase_timestamp")
    bounds = orders.agg(F.min(day).alias("first"), F.max(day).alias("last")).where("first is not null")
    start = F.trunc("first", "year")
    end = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return _calendar(bounds.select(_every_day(start, end)))


_CUSTOMER_ATTRIBUTES = (
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "source_system",
    "load_date",
)


def inferred_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers seen on orders only, one row each: ``(customer_id)``."""
    seen = orders.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    return seen.join(customers.select("customer_id"), "customer_id", "left_anti")


def dim_customer(customers: DataFrame, orders: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Known customers plus a bare row for every customer that only orders know.

    ``as_of`` stamps the bare rows (default: now). Known rows are unique by customer and the
    inferred ones are made distinct and never known, so the union needs no further distinct.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, dt.datetime):
        as_of = F.lit(as_of)
    types = {f.name: f.dataType for f in customers.schema}
    known = customers.where(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").alias("customer_key"), "customer_id", *_CUSTOMER_ATTRIBUTES, "ingestion_timestamp"
    )
    inferred = inferred_customers(orders, customers).select(
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        *[F.lit(None).cast(types[c]).alias(c) for c in _CUSTOMER_ATTRIBUTES],
        as_of.cast("timestamp").alias("ingestion_timestamp"),
    )
    return known.unionByName(inferred)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("product_id").alias("product_key"),
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "source_system",
        "load_date",
        "ingestion_timestamp",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        F.col("seller_id").alias("seller_key"),
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        "source_system",
        "load_date",
        "ingestion_timestamp",
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("total_order_items"),
        F.sum("price").alias("item_revenue"),
        F.sum("freight_value").alias("freight_revenue"),
        F.sum(F.col("price") + F.col("freight_value")).alias("gross_order_value"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_count"), F.sum("payment_value").alias("total_payment_value")
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order; items and payments are summed per order first, so nothing fans out."""
    delivered = F.col("order_delivered_customer_date")
    purchased = F.col("order_purchase_timestamp")
    joined = orders.join(items_per_order(items), "order_id", "left").join(
        payments_per_order(payments), "order_id", "left"
    )
    return joined.select(
        "order_id",
        "customer_id",
        F.to_date(purchased).alias("order_purchase_date"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "order_status",
        _or_zero("total_order_items"),
        _or_zero("item_revenue"),
        _or_zero("freight_revenue"),
        _or_zero("gross_order_value"),
        _or_zero("payment_count"),
        _or_zero("total_payment_value"),
        F.coalesce(delivered > F.col("order_estimated_delivery_date"), F.lit(False)).alias("is_late_delivery"),
        calendar.days_between(delivered, purchased).alias("delivery_days"),
        "source_system",
        "source_file_name",
        "load_date",
        "ingestion_timestamp",
    )


def _order_context(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("order_purchase_date"), "order_status"
    )


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line."""
    joined = lookup_join(
        items.drop("batch_id", "run_id", "gcs_uri", "file_hash"), _order_context(orders), "order_id"
    )
    return joined.select(
        F.concat("order_id", F.lit("-"), F.col("order_item_id").cast("string")).alias("order_item_key"),
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_purchase_date",
        "order_status",
        "shipping_limit_date",
        F.col("price").alias("item_revenue"),
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("gross_item_value"),
        "source_system",
        "source_file_name",
        "load_date",
        "ingestion_timestamp",
    )


def fact_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment of an order."""
    joined = lookup_join(
        payments.drop("batch_id", "run_id", "gcs_uri", "file_hash"), _order_context(orders), "order_id"
    )
    return joined.select(
        F.concat("order_id", F.lit("-"), F.col("payment_sequential").cast("string")).alias("payment_key"),
        "order_id",
        "customer_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        "order_purchase_date",
        "order_status",
        "source_system",
        "source_file_name",
        "load_date",
        "ingestion_timestamp",
    )
