"""Column contracts of the landed entities, the lineage columns and the audit logs (data only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Money and measures: nine decimals; 28 digits leave head-room so that sums stay exact at (38, 9).
MONEY = T.DecimalType(28, 9)


@dataclass(frozen=True)
class Field:
    """One landed column, the cleaning rule for it and its name in the trusted table."""

    source: str
    rule: str
    name: str = ""

    @property
    def target(self) -> str:
        return self.name or self.source


@dataclass(frozen=True)
class Entity:
    """A landed entity: its columns, business key and the filters applied before the casts."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    not_blank: tuple[str, ...]
    not_null: tuple[str, ...] = ()

    @property
    def required_columns(self) -> list[str]:
        return [f.source for f in self.fields]


def _fields(*specs: tuple[str, ...]) -> tuple[Field, ...]:
    return tuple(Field(*spec) for spec in specs)


# Entity names, required columns, keys.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "orders",
            _fields(
                ("order_id", "text"),
                ("customer_id", "text"),
                ("order_status", "lower"),
                ("order_purchase_timestamp", "timestamp"),
                ("order_approved_at", "timestamp"),
                ("order_delivered_carrier_date", "timestamp"),
                ("order_delivered_customer_date", "timestamp"),
                ("order_estimated_delivery_date", "timestamp"),
            ),
            key=("order_id",),
            not_blank=("order_id",),
        ),
        Entity(
            "customers",
            _fields(
                ("customer_id", "text"),
                ("customer_unique_id", "text"),
                ("customer_zip_code_prefix", "text"),
                ("customer_city", "lower"),
                ("customer_state", "upper"),
            ),
            key=("customer_id",),
            not_blank=("customer_id",),
        ),
        Entity(
            "order_items",
            _fields(
                ("order_id", "text"),
                ("order_item_id", "integer"),
                ("product_id", "text"),
                ("seller_id", "text"),
                ("shipping_limit_date", "timestamp"),
                ("price", "money"),
                ("freight_value", "money"),
            ),
            key=("order_id", "order_item_id"),
            not_blank=("order_id", "product_id", "seller_id"),
            not_null=("order_item_id",),
        ),
        Entity(
            "products",
            _fields(
                ("product_id", "text"),
                ("product_category_name", "category"),
                ("product_name_lenght", "integer", "product_name_length"),
                ("product_description_lenght", "integer", "product_description_length"),
                ("product_photos_qty", "integer"),
                ("product_weight_g", "money"),
                ("product_length_cm", "money"),
                ("product_height_cm", "money"),
                ("product_width_cm", "money"),
            ),
            key=("product_id",),
            not_blank=("product_id",),
        ),
        Entity(
            "payments",
            _fields(
                ("order_id", "text"),
                ("payment_sequential", "integer"),
                ("payment_type", "lower"),
                ("payment_installments", "integer"),
                ("payment_value", "money"),
            ),
            key=("order_id", "payment_sequential"),
            not_blank=("order_id",),
            not_null=("payment_sequential",),
        ),
        Entity(
            "sellers",
            _fields(
                ("seller_id", "text"),
                ("seller_zip_code_prefix", "text"),
                ("seller_city", "lower"),
                ("seller_state", "upper"),
            ),
            key=("seller_id",),
            not_blank=("seller_id",),
        ),
    )
}

# Lineage columns, in the order they are stamped on a row.
LINEAGE_TEXT = ("batch_id", "run_id", "source_system", "source_file_name", "gcs_uri", "file_hash")
LINEAGE = (*LINEAGE_TEXT, "load_date", "ingestion_timestamp")

# Accepted values of two columns.
ORDER_STATUSES = (
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "unavailable",
    "canceled",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

# Sources that may upload, and the upload size limit (100 MiB).
SOURCE_SYSTEMS = ("olist",)
MAX_FILE_BYTES = 100 * 1024 * 1024


def bronze_schema(entity: str) -> T.StructType:
    """Raw table: everything text but the ingest clock."""
    names = [*ENTITIES[entity].required_columns, *LINEAGE[:-1]]
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in names] + [T.StructField("ingestion_timestamp", T.TimestampType())]
    )


def _log(*names: str) -> T.StructType:
    kinds = {
        "start_time": T.TimestampType(),
        "end_time": T.TimestampType(),
        "created_at": T.TimestampType(),
        "row_count": T.LongType(),
        "failed_count": T.LongType(),
    }
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])


# The four audit logs.
AUDIT_LOGS: dict[str, T.StructType] = {
    "pipeline_run_log": _log(
        "run_id", "batch_id", "pipeline_name", "step_name", "status", "start_time", "end_time", "error_message"
    ),
    "data_quality_log": _log(
        "check_id",
        "run_id",
        "batch_id",
        "table_name",
        "check_name",
        "check_status",
        "expected_value",
        "actual_value",
        "failed_count",
        "created_at",
    ),
    "file_upload_log": _log(
        "upload_id",
        "run_id",
        "batch_id",
        "source_system",
        "table_name",
        "source_file_name",
        "gcs_uri",
        "file_hash",
        "row_count",
        "upload_status",
        "created_at",
        "error_message",
    ),
    "rejected_records": _log(
        "rejected_id",
        "run_id",
        "batch_id",
        "source_file_name",
        "gcs_uri",
        "rejection_level",
        "rejection_reason",
        "rejected_payload",
        "created_at",
    ),
}
