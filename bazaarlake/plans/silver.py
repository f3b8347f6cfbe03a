"""Trusted tables: filter on the raw text, cast and clean, keep the latest row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import ENTITIES, LINEAGE_TEXT, Entity, Field
from ..functions import casts
from ..operators.dedup import latest_per_key

_RULES = {
    "text": lambda c, tokens: casts.text(c),
    "lower": casts.clean_lower,
    "upper": casts.clean_upper,
    "category": casts.category,
    "integer": lambda c, tokens: casts.safe_integer(c),
    "money": lambda c, tokens: casts.safe_money(c),
    "timestamp": lambda c, tokens: casts.safe_timestamp(c),
}


def _usable(entity: Entity) -> Column:
    """The key filter looks at the raw text, before any cast."""
    checks = [casts.present(F.col(c)) for c in entity.not_blank] + [F.col(c).isNotNull() for c in entity.not_null]
    return reduce(lambda a, b: a & b, checks)


def _clean(field: Field, null_tokens: tuple[str, ...]) -> Column:
    return _RULES[field.rule](F.col(field.source), null_tokens).alias(field.target)


def typed(entity_name: str, bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a usable key, typed and cleaned, before duplicates are removed."""
    entity = ENTITIES[entity_name]
    lineage = [casts.text(F.col(c)).alias(c) for c in LINEAGE_TEXT]
    return bronze.where(_usable(entity)).select(
        *[_clean(f, null_tokens) for f in entity.fields],
        *lineage,
        casts.safe_date(F.col("load_date")).alias("load_date"),
        F.col("ingestion_timestamp").try_cast("timestamp").alias("ingestion_timestamp"),
    )


def trusted(entity_name: str, bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    """The trusted table of one entity: one row per business key."""
    return latest_per_key(typed(entity_name, bronze, null_tokens), ENTITIES[entity_name].key)


def silver_orders(bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    return trusted("orders", bronze, null_tokens)


def silver_customers(bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    return trusted("customers", bronze, null_tokens)


def silver_order_items(bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    return trusted("order_items", bronze, null_tokens)


def silver_products(bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    return trusted("products", bronze, null_tokens)


def silver_payments(bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    return trusted("payments", bronze, null_tokens)


def silver_sellers(bronze: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    return trusted("sellers", bronze, null_tokens)
