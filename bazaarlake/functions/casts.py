"""Casts that give NULL instead of an error, and text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import MONEY

# Characters that count as white space when a text is trimmed.
WHITESPACE = " \t\n\x0b\f\r\x85\xa0                　"

# Spark also reads '2017' and '10:56:33' (as a time of today); only texts that start with a full
# date may become a date or timestamp.
_STARTS_WITH_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def text(c: Column) -> Column:
    return c.cast("string")


def clean_text(c: Column, null_tokens: tuple[str, ...] = ()) -> Column:
    """Trimmed text; ``null_tokens`` names texts that stand for a missing value (such as ``nan``)."""
    trimmed = strip(text(c))
    if not null_tokens:
        return trimmed
    return F.when(~F.lower(trimmed).isin([t.lower() for t in null_tokens]), trimmed)


def clean_lower(c: Column, null_tokens: tuple[str, ...] = ()) -> Column:
    return F.lower(clean_text(c, null_tokens))


def clean_upper(c: Column, null_tokens: tuple[str, ...] = ()) -> Column:
    return F.upper(clean_text(c, null_tokens))


def category(c: Column, null_tokens: tuple[str, ...] = ()) -> Column:
    """Lower-case category; blank and missing become ``unknown``."""
    return F.coalesce(F.nullif(clean_lower(c, null_tokens), F.lit("")), F.lit("unknown"))


def safe_integer(c: Column) -> Column:
    return c.try_cast("bigint")


def safe_money(c: Column) -> Column:
    return c.try_cast(MONEY)


def safe_timestamp(c: Column) -> Column:
    return F.when(c.rlike(_STARTS_WITH_DATE), c.try_cast("timestamp"))


def safe_date(c: Column) -> Column:
    return F.when(c.rlike(_STARTS_WITH_DATE), c.try_cast("date"))


def present(c: Column) -> Column:
    """Neither NULL nor blank. Trimming one side is enough to see that."""
    return c.isNotNull() & (F.ltrim(text(c), F.lit(WHITESPACE)) != "")
