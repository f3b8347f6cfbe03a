"""Build the trusted layer, then the star schema and marts; tests guard each layer.

A build stages its tables and tests them; only then do they become the lake's, all layers together, so a test that fails keeps the last
good tables. ``refresh`` builds everything from the raw rows; ``refresh_changes`` only what the raw rows of new ingests touch, with
the same result.

The trusted tables lie in folders by a hash of their first key column. Orders, items and payments share that column, so what an
order needs lies in folders of one number in all three. Facts and the sales mart lie in folders by day.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import AUDIT_LOGS, ENTITIES
from ..operators.checks import TableTests
from ..operators.dedup import latest_per_key
from ..session import materialize, scratch_scope
from ..sources.tables import Lake
from . import gold, ingest, marts, quality, silver
from .candidate import Candidate, among

Rules = tuple[tuple[str, str, str], ...]

BUCKETS = 64
BUCKET, DAY = "key_bucket", "order_purchase_date"

_LAYERS = {"silver_": "silver", "": "gold"}
_REFRESHED = T.StructType([T.StructField(n, T.StringType()) for n in ("ingest_id", "load_date", "buckets")])


def _bucket(entity: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(ENTITIES[entity].key[0]), F.lit(buckets)).cast("int").alias(BUCKET)


def _trusted(tables: Candidate, entity: str) -> DataFrame:
    return tables.read(f"silver_{entity}").drop(BUCKET)


def read_silver(lake: Lake, entity: str) -> DataFrame:
    """A trusted table of the lake."""
    return lake.read("silver", f"silver_{entity}").drop(BUCKET)


# --- the whole ------------------------------------------------------------------------------------


def stage_silver(tables: Candidate, null_tokens: tuple[str, ...] = (), warn_only: Rules = (), buckets: int = BUCKETS) -> list:
    """Stage the six trusted tables and test them."""
    for entity in ENTITIES:
        rows = silver.trusted(entity, ingest.read_bronze(tables.lake, entity), null_tokens)
        tables.write(f"silver_{entity}", rows.select("*", _bucket(entity, buckets)), day=BUCKET)
    return quality.enforce(quality.SILVER_TESTS, tables.read, warn_only)


def stage_gold(
    tables: Candidate,
    as_of: dt.datetime | None = None,
    calendar: tuple[dt.date, dt.date] = (gold.CALENDAR_START, gold.CALENDAR_END),
    warn_only: Rules = (),
    tests: dict[str, TableTests] = quality.GOLD_TESTS,
) -> list:
    """Stage dimensions, facts and marts and test them.

    The trusted tables are read from storage, so the joins run on plain scans: Spark broadcasts a
    side it has measured to be small and splits skewed partitions of the others at run time.
    """
    orders, items, payments = (_trusted(tables, e) for e in ("orders", "order_items", "payments"))
    by_day = {"day": DAY}
    _stage_dimensions(tables, as_of, calendar)
    tables.write("fact_orders", gold.fact_orders(orders, items, payments), **by_day, cluster_by=("customer_id", "order_status"))
    tables.write("fact_order_items", gold.fact_order_items(items, orders), **by_day, cluster_by=("product_id", "seller_id"))
    tables.write("fact_payments", gold.fact_payments(payments, orders), **by_day, cluster_by=("payment_type",))
    sales = marts.mart_sales_performance(tables.read("fact_order_items"), tables.read("dim_product"))
    tables.write("mart_sales_performance", sales, **by_day, cluster_by=("product_category_name",))
    _stage_whole_marts(tables)
    return quality.enforce(tests, tables.read, warn_only)


def _stage_dimensions(tables: Candidate, as_of: dt.datetime | None, calendar: tuple[dt.date, dt.date]) -> None:
    customers, orders = _trusted(tables, "customers"), _trusted(tables, "orders")
    tables.write("dim_date", gold.dim_date(tables.lake.spark, *calendar))
    tables.write("dim_customer", gold.dim_customer(customers, orders, as_of), cluster_by=("customer_state",), spread_by=("customer_id",))
    products = gold.dim_product(_trusted(tables, "products"))
    tables.write("dim_product", products, cluster_by=("product_category_name",), spread_by=("product_id",))
    tables.write("dim_seller", gold.dim_seller(_trusted(tables, "sellers")), cluster_by=("seller_state",), spread_by=("seller_id",))


def _stage_whole_marts(tables: Candidate) -> None:
    """The marts whose rows hang on the whole: ranks, the analysis date, the logs."""
    products = marts.mart_product_performance(tables.read("fact_order_items"), tables.read("dim_product"))
    tables.write("mart_product_performance", products, cluster_by=("product_category_name",), spread_by=("product_id",))
    people = marts.mart_customer_rfm(tables.read("fact_orders"), tables.read("dim_customer"))
    tables.write("mart_customer_rfm", people, cluster_by=("customer_segment", "customer_state"), spread_by=("customer_id",))
    logs = {name: ingest.read_log(tables.lake, name) for name in AUDIT_LOGS}
    health = marts.mart_pipeline_quality(
        logs["pipeline_run_log"], logs["data_quality_log"], logs["rejected_records"], logs["file_upload_log"]
    )
    tables.write("mart_pipeline_quality", health)


def build_silver(lake: Lake, null_tokens: tuple[str, ...] = (), warn_only: Rules = (), buckets: int = BUCKETS) -> list:
    """Rebuild the trusted layer alone."""
    tables = Candidate(lake, _LAYERS)
    results = stage_silver(tables, null_tokens, warn_only, buckets)
    tables.commit()
    return results


def build_gold(lake: Lake, as_of: dt.datetime | None = None, **options) -> list:
    """Rebuild the star schema and marts from the trusted layer."""
    tables = Candidate(lake, _LAYERS)
    with scratch_scope(lake.spark):
        results = stage_gold(tables, as_of, **options)
        tables.commit()
    return results


def refresh(
    lake: Lake,
    as_of: dt.datetime | None = None,
    warn_only: Rules = (),
    null_tokens: tuple[str, ...] = (),
    buckets: int = BUCKETS,
    **gold_options,
) -> list:
    """Both layers from all raw rows; the star schema is only built when the trusted layer passes its tests."""
    tables = Candidate(lake, _LAYERS)
    with scratch_scope(lake.spark):
        taken = materialize(_ingests(lake), "ingests")
        results = stage_silver(tables, null_tokens, warn_only, buckets)
        results += stage_gold(tables, as_of, warn_only=warn_only, **gold_options)
        tables.commit()
        lake.overwrite("audit", "refreshed_ingests", taken.withColumn("buckets", F.lit(buckets).cast("string")))
    return results


# --- what has changed -----------------------------------------------------------------------------


def _ingests(lake: Lake) -> DataFrame:
    """``(ingest_id, load_date)`` of the raw rows; both are folders, so no rows are read for them."""
    parts = [ingest.read_bronze(lake, entity).select("ingest_id", "load_date").distinct() for entity in ENTITIES]
    return reduce(DataFrame.unionByName, parts).distinct()


def _restricted(tables: Candidate, entity: str, orders: DataFrame, numbers: list[int]) -> DataFrame:
    """Trusted rows of some orders; only the folders of their numbers are read."""
    rows = tables.read(f"silver_{entity}").where(among(F.col(BUCKET), numbers)).drop(BUCKET)
    return rows.join(orders, "order_id", "left_semi")


def _values(df: DataFrame, column: str) -> list:
    """Distinct folder values, few by the layout: a bounded number of hash values, or days."""
    return [row[column] for row in df.select(column).distinct().collect()]


def refresh_changes(
    lake: Lake,
    as_of: dt.datetime | None = None,
    warn_only: Rules = (),
    null_tokens: tuple[str, ...] = (),
    calendar: tuple[dt.date, dt.date] = (gold.CALENDAR_START, gold.CALENDAR_END),
) -> list:
    """Bring both layers up to date with the ingests since the last refresh; the same tables as ``refresh`` would give.

    New raw rows compete with the trusted rows of their keys, as the latest of both is the latest of all. Orders with a new row in any of
    the three tables are touched; the days they had or have are made again from their new facts and the present facts of the other orders.
    Days with items of a product whose category has changed are made again in the sales mart. Dimensions and marts whose rows hang on the whole
    table are rebuilt. All tests run on the result, and nothing changes unless they pass. An ingest that was run again, or batches that were
    deleted, need ``refresh``.
    """
    if not lake.exists("audit", "refreshed_ingests"):
        return refresh(lake, as_of, warn_only, null_tokens, calendar=calendar)
    spark = lake.spark
    with scratch_scope(spark):
        taken = lake.read("audit", "refreshed_ingests")
        fresh = materialize(_ingests(lake).join(taken, ["ingest_id", "load_date"], "left_anti"), "ingests")
        ids = _values(fresh, "ingest_id")
        if not ids:
            return []
        buckets = int(taken.first()["buckets"])
        tables = Candidate(lake, _LAYERS)
        touched = []
        for entity in ENTITIES:
            raw = ingest.read_bronze(lake, entity).where(F.col("ingest_id").isin(ids))
            rows = silver.typed(entity, raw, null_tokens).select("*", _bucket(entity, buckets))
            rows = materialize(rows, f"new_{entity}")
            numbers = _values(rows, BUCKET)
            if not numbers:
                continue
            name = f"silver_{entity}"
            rivals = tables.current(name).where(among(F.col(BUCKET), numbers)).unionByName(rows)
            tables.replace(name, latest_per_key(rivals, ENTITIES[entity].key), BUCKET, numbers)
            if ENTITIES[entity].key[0] == "order_id":
                touched.append(rows.select("order_id", BUCKET))
        results = quality.enforce(quality.SILVER_TESTS, tables.read, warn_only)

        empty = spark.createDataFrame([], f"order_id string, {BUCKET} int")
        orders = materialize(reduce(DataFrame.unionByName, touched, empty).distinct(), "touched_orders")
        _stage_dimensions(tables, as_of, calendar)
        _stage_facts(tables, orders)
        _stage_whole_marts(tables)
        results += quality.enforce(quality.GOLD_TESTS, tables.read, warn_only)
        tables.commit()
        # Last: a refresh that is cut off before is done again, with the same outcome.
        done = taken.unionByName(fresh.withColumn("buckets", F.lit(buckets).cast("string")))
        lake.overwrite("audit", "refreshed_ingests", done)
    return results


def _stage_facts(tables: Candidate, touched: DataFrame) -> None:
    """Facts and the sales mart of the days that the touched orders had or have."""
    keys, numbers = touched.select("order_id"), _values(touched, BUCKET)
    orders, items, payments = (_restricted(tables, e, keys, numbers) for e in ("orders", "order_items", "payments"))
    made = {
        "fact_orders": gold.fact_orders(orders, items, payments),
        "fact_order_items": gold.fact_order_items(items, orders),
        "fact_payments": gold.fact_payments(payments, orders),
    }
    sold_days: list = []
    for name, rows in made.items():
        rows = materialize(rows, f"new_{name}")
        present = tables.current(name)
        before = present.select("order_id", DAY).join(keys, "order_id", "left_semi")
        days = sorted(set(_values(rows, DAY)) | set(_values(before, DAY)), key=lambda d: (d is None, d))
        if name == "fact_order_items":
            sold_days = days
        if days:
            others = present.where(among(F.col(DAY), days)).join(keys, "order_id", "left_anti")
            tables.replace(name, others.unionByName(rows.select(others.columns)), DAY, days)

    now, then = tables.read("dim_product"), tables.current("dim_product")
    moved = now.select("product_id", F.col("product_category_name").alias("now")).join(
        then.select("product_id", F.col("product_category_name").alias("then")), "product_id", "full"
    )
    moved = moved.where(~F.col("now").eqNullSafe(F.col("then"))).select("product_id")
    items = tables.read("fact_order_items")
    moved_days = _values(items.select("product_id", DAY).join(moved, "product_id", "left_semi"), DAY)
    days = [d for d in {*sold_days, *moved_days} if d is not None]
    if days:
        sales = marts.mart_sales_performance(items.where(F.col(DAY).isin(days)), now)
        tables.replace("mart_sales_performance", sales, DAY, days)
