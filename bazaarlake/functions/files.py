"""Expressions over file paths and names of the landing zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_value(path: Column, name: str) -> Column:
    """Value of a ``name=value`` folder in a path, NULL when the folder is missing."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){name}=([^/]+)/", 1), F.lit(""))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def safe_file_name(name: Column, fallback: Column) -> Column:
    """Base name with every character but letters, digits, ``_``, ``-`` and ``.`` replaced by ``_``.

    ``fallback`` is a short id for names that are empty.
    """
    base = F.substring_index(F.substring_index(name, "/", -1), "\\", -1)
    cleaned = F.regexp_replace(base, r"[^\p{L}\p{N}_.\-]", "_")
    return F.when(cleaned == "", F.concat(F.lit("uploaded_file_"), F.substring(fallback, 1, 8), F.lit(".csv"))).otherwise(
        cleaned
    )


def upload_batch_id(at: Column, file_hash: Column) -> Column:
    """``ui_<date>_<time>_<8 hex digits>``; the digits come from the content so a retry keeps the id."""
    return F.concat(
        F.lit("ui_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit("_"), F.substring(file_hash, 1, 8)
    )


def zone_path(zone: Column, source: Column, table: Column, load_date: Column, batch: Column, name: Column) -> Column:
    """Where a file goes after the checks: ``<zone>/source=/table=/load_date=/batch_id=/<name>``."""
    return F.concat(
        zone,
        F.lit("/source="),
        source,
        F.lit("/table="),
        table,
        F.lit("/load_date="),
        load_date,
        F.lit("/batch_id="),
        batch,
        F.lit("/"),
        name,
    )


def has_csv_suffix(name: Column) -> Column:
    return F.lower(name).endswith(".csv")


def stable_id(*parts: Column) -> Column:
    """Id derived from its parts, so that a repeated run writes the same id again."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
