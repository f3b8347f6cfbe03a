"""Operational queries over the raw tables and the audit logs, and the dashboard tiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import LINEAGE
from ..operators.joins import missing_parents as _missing_parents

def _rows() -> Column:
    return F.count(F.lit(1))


# --- latest entries of the audit logs -----------------------------------------------------------


def _latest(log: DataFrame, columns: tuple[str, ...], clock: str, limit: int, tiebreak: str) -> DataFrame:
    return log.orderBy(F.col(clock).desc_nulls_last(), F.col(tiebreak)).limit(limit).select(*columns)


def latest_uploads(log: DataFrame, limit: int = 20) -> DataFrame:
    columns = ("table_name", "source_file_name", "upload_status", "row_count", "error_message", "created_at")
    return _latest(log, columns, "created_at", limit, "upload_id")


def latest_steps(log: DataFrame, limit: int = 50) -> DataFrame:
    columns = ("batch_id", "step_name", "status", "error_message", "start_time")
    return _latest(log, columns, "start_time", limit, "run_id")


def latest_checks(log: DataFrame, limit: int = 50) -> DataFrame:
    columns = ("batch_id", "table_name", "check_name", "check_status", "actual_value", "failed_count", "created_at")
    return _latest(log, columns, "created_at", limit, "check_id")


def latest_rejections(log: DataFrame, limit: int = 20) -> DataFrame:
    columns = ("batch_id", "source_file_name", "gcs_uri", "rejection_level", "rejection_reason", "created_at")
    return _latest(log, columns, "created_at", limit, "rejected_id")


# --- one batch across the logs ------------------------------------------------------------------


def batch_steps(runs: DataFrame, batch_id: str) -> DataFrame:
    """Steps of one batch in time order."""
    return (
        runs.where(F.col("batch_id") == batch_id)
        .select("batch_id", "step_name", "status", "error_message", "start_time")
        .orderBy("start_time")
    )


def batch_trace(
    runs: DataFrame, checks: DataFrame, uploads: DataFrame, rejected: DataFrame, batch_id: str | None = None
) -> DataFrame:
    """What the four logs say about each run, in one shape: ``(batch_id, run_id, log, entry, status, at)``."""

    def part(log: DataFrame, name: str, entry: Column, status: Column, at: str) -> DataFrame:
        if batch_id is not None:
            log = log.where(F.col("batch_id") == batch_id)
        return log.select(
            "batch_id",
            "run_id",
            F.lit(name).alias("log"),
            entry.alias("entry"),
            status.alias("status"),
            F.col(at).alias("at"),
        )

    parts = [
        part(runs, "pipeline_run_log", F.col("step_name"), F.col("status"), "start_time"),
        part(checks, "data_quality_log", F.col("check_name"), F.col("check_status"), "created_at"),
        part(uploads, "file_upload_log", F.col("source_file_name"), F.col("upload_status"), "created_at"),
        part(rejected, "rejected_records", F.col("rejection_reason"), F.col("rejection_level"), "created_at"),
    ]
    return reduce(DataFrame.unionByName, parts)


def lineage_sample(bronze: DataFrame, batch_id: str | None = None, limit: int = 10) -> DataFrame:
    """Lineage columns of a few rows, newest first."""
    if batch_id is not None:
        bronze = bronze.where(F.col("batch_id") == batch_id)
    rows = bronze.select(*LINEAGE)
    return rows.orderBy(F.col("ingestion_timestamp").desc_nulls_last(), *[F.col(c) for c in LINEAGE[:-1]]).limit(limit)


# --- counts -------------------------------------------------------------------------------------


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(_rows().alias("total_rows"))


def rows_per(df: DataFrame, column: str, largest_first: bool = False) -> DataFrame:
    """Rows per batch or per source file."""
    counts = df.groupBy(column).agg(_rows().alias("row_count"))
    return counts.orderBy(F.desc("row_count"), column) if largest_first else counts.orderBy(column)


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    return rows_per(df, column, largest_first=True)


def total_vs_distinct(df: DataFrame, key: str) -> DataFrame:
    """Equal numbers mean that the key is unique.

    Counting per key first (with map-side totals) needs one shuffle of the keys.
    """
    per_key = df.groupBy(key).agg(_rows().alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.col(key)).alias("distinct_keys")
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(_rows().alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def missing_parent_rows(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Keys of the child that the parent lacks, with their number of rows."""
    return _missing_parents(child, key, parent, key)


def missing_parent_count(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Child rows without a parent; a NULL key has none either."""
    orphans = missing_parent_rows(child, key, parent).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    nulls = child.where(F.col(key).isNull()).agg(_rows().alias("n"))
    return orphans.unionByName(nulls).agg(F.sum("n").cast("bigint").alias("missing_rows"))


# --- events -------------------------------------------------------------------------------------


def events_named(events: DataFrame, name: str) -> DataFrame:
    return events.where(F.col("event") == name)


def events_of_batch(events: DataFrame, batch_id: str) -> DataFrame:
    return events.where(F.col("batch_id") == batch_id)


def server_errors(events: DataFrame) -> DataFrame:
    return events.where(F.col("status") >= 500)


# --- dashboard tiles ----------------------------------------------------------------------------


def kpi_totals(orders: DataFrame) -> DataFrame:
    """Revenue, orders and customers over the order fact."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n"),
        F.sum("gross_order_value").alias("gross"),
        F.sum("item_revenue").alias("items"),
        F.sum("total_payment_value").alias("paid"),
    )
    return per_customer.agg(
        F.sum("n").alias("total_orders"),
        F.count("customer_id").alias("total_customers"),
        F.sum("items").cast("decimal(38,9)").alias("item_revenue"),
        F.sum("gross").cast("decimal(38,9)").alias("gross_revenue"),
        F.sum("paid").cast("decimal(38,9)").alias("total_payments"),
    )


def monthly_sales(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly revenue over the sales mart; the calendar has one row per day."""
    per_day = sales.groupBy("order_purchase_date").agg(
        F.sum("total_items_sold").alias("items"), F.sum("gross_revenue").alias("gross")
    )
    days = calendar.select(F.col("date_key").alias("order_purchase_date"), "year", "month", "month_name")
    return (
        per_day.join(days, "order_purchase_date")
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("items").alias("total_items_sold"),
            F.sum("gross").cast("decimal(38,9)").alias("gross_revenue"),
        )
    )


def status_split(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(_rows().alias("total_orders"))


def customers_by_state(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_state").agg(_rows().alias("total_customers"))


def segment_sizes(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("customer_segment").agg(
        _rows().alias("total_customers"), F.sum("monetary_value").cast("decimal(38,9)").alias("monetary_value")
    )


def top_products(products: DataFrame, limit: int = 10) -> DataFrame:
    """Best products of the product mart."""
    return products.orderBy("revenue_rank", "product_id").limit(limit)


def seller_performance(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Sales per seller with the place of the seller."""
    totals = items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        _rows().alias("units_sold"),
        F.sum("gross_item_value").alias("gross_revenue"),
    )
    return totals.join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left")


def category_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_category_name").agg(
        F.sum("total_items_sold").alias("total_items_sold"),
        F.sum("gross_revenue").cast("decimal(38,9)").alias("gross_revenue"),
    )


def pipeline_health(quality: DataFrame) -> DataFrame:
    """Uploads, rejections, checks and runs over all days of the quality mart."""
    names = [c for c in quality.columns if c != "run_date"]
    return quality.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
