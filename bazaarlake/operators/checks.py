"""Data tests: each counts the rows that break a rule; zero means the test passes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import missing_parents


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_together: tuple[tuple[str, ...], ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def count(self) -> int:
        return sum(
            len(part)
            for part in (
                self.not_null,
                self.unique,
                self.unique_together,
                self.accepted,
                self.non_negative,
                self.parents,
            )
        )


# --- failing rows of one rule -------------------------------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def negative_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def unaccepted_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Values outside the list with their number of rows; NULL is left to ``not_null``."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def repeated_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Keys held by more than one row, NULL keys included."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; NULL may repeat."""
    return repeated_keys(df.where(F.col(column).isNotNull()), column)


# --- summary of all rules -----------------------------------------------------------------------


def _row_rules(tests: TableTests) -> list[tuple[str, str, Column]]:
    """(test, column, failure count) of the rules that look at one row, or one value, at a time."""
    rules = [("not_null", c, F.count_if(F.col(c).isNull())) for c in tests.not_null]
    rules += [("non_negative", c, F.count_if(F.col(c) < 0)) for c in tests.non_negative]
    # A value outside the list counts once, as one failing group.
    rules += [
        ("accepted_values", c, F.count_distinct(F.when(~F.col(c).isin(*values), F.col(c))))
        for c, values in tests.accepted.items()
    ]
    return rules


def _one_pass(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """All row rules of a table in a single scan, one result row per rule."""
    counts = df.agg(*[count.alias(f"n{i}") for i, (_, _, count) in enumerate(rules)])
    entries = [
        F.struct(
            F.lit(test).alias("test"), F.lit(column).alias("column_name"), F.col(f"n{i}").cast("bigint").alias("failures")
        )
        for i, (test, column, _) in enumerate(rules)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def _counted(failing: DataFrame, test: str, column: str, count: Column | None = None) -> DataFrame:
    count = F.count(F.lit(1)) if count is None else F.coalesce(F.sum(count), F.lit(0))
    return failing.agg(count.cast("bigint").alias("failures")).select(
        F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failures"
    )


def check_table(name: str, tests: TableTests, table: Callable[[str], DataFrame]) -> DataFrame:
    """Result rows ``(model, test, column_name, failures)`` of all tests of one table."""
    df = table(name)
    parts = []
    row_rules = _row_rules(tests)
    if row_rules:
        parts.append(_one_pass(df, row_rules))
    parts += [_counted(repeated_values(df, c), "unique", c) for c in tests.unique]
    parts += [_counted(repeated_keys(df, *cs), "unique_together", ",".join(cs)) for cs in tests.unique_together]
    parts += [
        _counted(missing_parents(df, c, table(parent), key), "relationships", c, F.col("row_count"))
        for c, (parent, key) in tests.parents.items()
    ]
    return reduce(DataFrame.unionByName, parts).select(F.lit(name).alias("model"), "test", "column_name", "failures")


def run_tests(
    tests: dict[str, TableTests],
    table: Callable[[str], DataFrame],
    warn_only: tuple[tuple[str, str, str], ...] = (),
) -> DataFrame:
    """All declared tests: ``(model, test, column_name, failures, status)``.

    ``warn_only`` lists (model, test, column) of tests that warn instead of failing.
    """
    results = reduce(DataFrame.unionByName, [check_table(name, t, table) for name, t in tests.items()])
    mild = reduce(
        lambda a, b: a | b,
        [(F.col("model") == m) & (F.col("test") == t) & (F.col("column_name") == c) for m, t, c in warn_only],
        F.lit(False),
    )
    status = F.when(F.col("failures") == 0, "PASS").when(mild, "WARN").otherwise("ERROR")
    return results.withColumn("status", status)


def summarize(results: DataFrame, skipped: int = 0) -> DataFrame:
    """One row with the number of passed, warned, failed and skipped tests."""
    return results.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count_if(F.col("status") == "ERROR").alias("failed"),
        F.lit(skipped).cast("bigint").alias("skipped"),
        (F.count(F.lit(1)) + F.lit(skipped)).alias("total"),
    )


def freshness(tables: dict[str, DataFrame], as_of: Column, warn_after_hours: int) -> DataFrame:
    """Latest ingest time per table and whether it is older than the limit."""
    parts = [
        df.agg(F.max("ingestion_timestamp").alias("latest")).select(F.lit(name).alias("table_name"), "latest")
        for name, df in tables.items()
    ]
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("latest")) / 3600
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(age <= warn_after_hours, "PASS").otherwise("WARN")
    )


def failing_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the names of the rules they break in ``reasons`` (empty for good rows)."""
    named = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]))
    return df.withColumn("reasons", named)


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into good rows and rows set aside at level ROW with their reasons."""
    marked = failing_rows(df, rules)
    good = marked.where(F.size("reasons") == 0).drop("reasons")
    bad = (
        marked.where(F.size("reasons") > 0)
        .withColumn("rejection_level", F.lit("ROW"))
        .withColumn("rejection_reason", F.concat_ws("; ", "reasons"))
        .drop("reasons")
    )
    return good, bad
