"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(d: Column) -> Column:
    """Week 0-53 with weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def days_between(end: Column, start: Column) -> Column:
    """Number of midnights between two dates or timestamps."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
