"""Declared data tests of the trusted and the star-schema tables, and the gate between layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..contracts import ORDER_STATUSES, PAYMENT_TYPES
from ..operators.checks import TableTests, run_tests

# The 47 tests of the trusted tables.
SILVER_TESTS: dict[str, TableTests] = {
    "silver_orders": TableTests(
        not_null=("order_id", "customer_id", "order_status", "ingestion_timestamp"),
        unique=("order_id",),
        accepted={"order_status": ORDER_STATUSES},
    ),
    "silver_customers": TableTests(
        not_null=("customer_id", "customer_unique_id", "customer_state", "ingestion_timestamp"),
        unique=("customer_id",),
    ),
    "silver_products": TableTests(
        not_null=("product_id", "product_category_name", "ingestion_timestamp"),
        unique=("product_id",),
        non_negative=("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
    ),
    "silver_sellers": TableTests(
        not_null=("seller_id", "seller_city", "seller_state", "ingestion_timestamp"),
        unique=("seller_id",),
    ),
    "silver_payments": TableTests(
        not_null=("order_id", "payment_sequential", "payment_type", "payment_value", "ingestion_timestamp"),
        unique_together=(("order_id", "payment_sequential"),),
        accepted={"payment_type": PAYMENT_TYPES},
        non_negative=("payment_installments", "payment_value"),
        parents={"order_id": ("silver_orders", "order_id")},
    ),
    "silver_order_items": TableTests(
        not_null=(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "price",
            "freight_value",
            "ingestion_timestamp",
        ),
        unique_together=(("order_id", "order_item_id"),),
        non_negative=("price", "freight_value"),
        parents={
            "order_id": ("silver_orders", "order_id"),
            "product_id": ("silver_products", "product_id"),
            "seller_id": ("silver_sellers", "seller_id"),
        },
    ),
}

# The 55 tests of the star schema and the marts.
GOLD_TESTS: dict[str, TableTests] = {
    "dim_date": TableTests(not_null=("date_key",), unique=("date_key",)),
    "dim_customer": TableTests(not_null=("customer_id", "customer_unique_id"), unique=("customer_id",)),
    "dim_product": TableTests(not_null=("product_id", "product_category_name"), unique=("product_id",)),
    "dim_seller": TableTests(not_null=("seller_id",), unique=("seller_id",)),
    "fact_orders": TableTests(
        not_null=("order_id", "customer_id", "order_purchase_date", "order_status"),
        unique=("order_id",),
        accepted={"order_status": ORDER_STATUSES},
        non_negative=("gross_order_value", "total_payment_value"),
        parents={"customer_id": ("dim_customer", "customer_id"), "order_purchase_date": ("dim_date", "date_key")},
    ),
    "fact_order_items": TableTests(
        not_null=(
            "order_item_key",
            "order_id",
            "product_id",
            "seller_id",
            "order_purchase_date",
            "item_revenue",
            "freight_value",
            "gross_item_value",
        ),
        unique=("order_item_key",),
        non_negative=("item_revenue", "freight_value", "gross_item_value"),
        parents={
            "order_id": ("fact_orders", "order_id"),
            "product_id": ("dim_product", "product_id"),
            "seller_id": ("dim_seller", "seller_id"),
            "order_purchase_date": ("dim_date", "date_key"),
        },
    ),
    "fact_payments": TableTests(
        not_null=("payment_key", "order_id", "payment_type", "payment_value"),
        unique=("payment_key",),
        accepted={"payment_type": PAYMENT_TYPES},
        non_negative=("payment_value",),
        parents={"order_id": ("fact_orders", "order_id")},
    ),
    "mart_sales_performance": TableTests(
        not_null=("order_purchase_date", "product_category_name"), non_negative=("gross_revenue",)
    ),
    "mart_customer_rfm": TableTests(
        not_null=("customer_id", "customer_segment"), unique=("customer_id",), non_negative=("monetary_value",)
    ),
    "mart_product_performance": TableTests(
        not_null=("product_id",), unique=("product_id",), non_negative=("gross_revenue",)
    ),
    "mart_pipeline_quality": TableTests(not_null=("run_date",)),
}


class QualityGateError(RuntimeError):
    """Raised when a layer breaks one of its tests; ``failures`` lists them."""

    def __init__(self, failures: list):
        self.failures = failures
        lines = [f"{f.model}.{f.column_name} {f.test}: {f.failures}" for f in failures]
        super().__init__(f"{len(failures)} data tests failed: " + "; ".join(lines))


def enforce(
    tests: dict[str, TableTests],
    table: Callable[[str], DataFrame],
    warn_only: tuple[tuple[str, str, str], ...] = (),
) -> list:
    """Run the tests and raise if any row breaks one; returns the result rows (one per test)."""
    results = run_tests(tests, table, warn_only).collect()
    failures = [r for r in results if r.status == "ERROR"]
    if failures:
        raise QualityGateError(failures)
    return results
