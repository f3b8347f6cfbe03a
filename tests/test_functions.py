import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlake.functions import calendar, casts, files


def _one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "value, expected", [("40", 40), ("40.0", None), ("abc", None), ("", None), (None, None), (" 7 ", 7), ("-3", -3)]
)
def test_safe_integer(spark, value, expected):
    assert _one(spark, casts.safe_integer, value) == expected


@pytest.mark.parametrize("value, expected", [("12.5", Decimal("12.5")), ("1e2", Decimal(100)), ("x", None), ("", None)])
def test_safe_money(spark, value, expected):
    assert _one(spark, casts.safe_money, value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2017-10-02 10:56:33", dt.datetime(2017, 10, 2, 10, 56, 33)),
        ("2017-10-02", dt.datetime(2017, 10, 2)),
        ("2017", None),
        ("10:56:33", None),
        ("2017-13-02", None),
        ("", None),
        (None, None),
    ],
)
def test_safe_timestamp(spark, value, expected):
    text = casts.safe_timestamp(F.lit(value).cast("string")).cast("string")
    got = spark.range(1).select(text.alias("r")).first().r
    assert got == (expected and expected.isoformat(" "))


def test_safe_date(spark):
    assert _one(spark, casts.safe_date, "2017-10-02") == dt.date(2017, 10, 2)
    assert _one(spark, casts.safe_date, "2017") is None


@pytest.mark.parametrize(
    "value, lower, category",
    [
        ("  Sao Paulo\t", "sao paulo", "sao paulo"),
        (" \n", "", "unknown"),
        (None, None, "unknown"),
        ("nan", "nan", "nan"),
        ("　X\xa0", "x", "x"),
    ],
)
def test_text_cleaning(spark, value, lower, category):
    assert _one(spark, casts.clean_lower, value) == lower
    assert _one(spark, casts.category, value) == category


def test_null_tokens(spark):
    assert _one(spark, lambda c: casts.category(c, ("nan", "None")), " NaN ") == "unknown"
    assert _one(spark, lambda c: casts.clean_upper(c, ("nan",)), " sp ") == "SP"


@pytest.mark.parametrize("value, expected", [("a", True), (" a", True), ("  ", False), ("\t", False), ("", False)])
def test_present(spark, value, expected):
    assert _one(spark, casts.present, value) is expected
    assert _one(spark, casts.present, None) is False


@pytest.mark.parametrize(
    "day, week", [("2016-01-01", 0), ("2016-01-03", 1), ("2017-01-01", 1), ("2016-12-31", 52), ("2017-12-31", 53)]
)
def test_week_starts_on_sunday(spark, day, week):
    assert _one(spark, lambda c: calendar.week_of_year(F.to_date(c)), day) == week


def test_days_between_counts_midnights(spark):
    late, early = F.lit("2020-01-02 00:01:00").cast("timestamp"), F.lit("2020-01-01 23:59:00").cast("timestamp")
    assert spark.range(1).select(calendar.days_between(late, early).alias("r")).first().r == 1


@pytest.mark.parametrize(
    "name, expected",
    [
        ("my file(1).csv", "my_file_1_.csv"),
        ("C:\\x\\açai.csv", "açai.csv"),
        ("a/b/c.csv", "c.csv"),
        ("dir/", "uploaded_file_12345678.csv"),
    ],
)
def test_safe_file_name(spark, name, expected):
    assert _one(spark, lambda c: files.safe_file_name(c, F.lit("1234567890")), name) == expected


def test_paths(spark):
    path = "tmp/source=olist/table=orders/upload_id=b1/x.CSV"
    assert _one(spark, lambda c: files.path_value(c, "table"), path) == "orders"
    assert _one(spark, lambda c: files.path_value(c, "load_date"), path) is None
    assert _one(spark, files.file_name, path) == "x.CSV"
    assert _one(spark, files.has_csv_suffix, path) is True
    at = F.lit(dt.datetime(2024, 1, 2, 3, 4, 5))
    assert _one(spark, lambda c: files.upload_batch_id(at, c), "abcdef0123") == "ui_20240102_030405_abcdef01"
