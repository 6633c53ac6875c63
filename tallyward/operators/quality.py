"""Data tests: failing rows of one test, or a result table for many."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.joins import orphans


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once (nulls are not counted)."""
    return unique_combination(df.where(F.col(col).isNotNull()), [col])


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Non-null values outside the list, with their count."""
    bad = df.where(~F.col(col).isin(list(values)))
    return bad.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(df: DataFrame, col: str, to: DataFrame, field: str) -> DataFrame:
    return orphans(df, col, to, field)


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows where the expression is false; null passes."""
    return df.where(~F.expr(expression))


def freshness(df: DataFrame, ts: str, as_of: str, warn_days: float | None = None,
              error_days: float | None = None) -> DataFrame:
    """Newest timestamp, its age at ``as_of`` and pass / warn / error; no rows are an error."""
    age = F.timestamp_diff("SECOND", F.max(F.col(ts).cast("timestamp")), F.to_timestamp(F.lit(as_of)))
    out = df.agg(F.max(F.col(ts)).alias("max_loaded_at"), age.alias("age_seconds"))
    status = F.when(F.col("age_seconds").isNull(), "error")
    if error_days is not None:
        status = status.when(F.col("age_seconds") > int(error_days * 86400), "error")
    if warn_days is not None:
        status = status.when(F.col("age_seconds") > int(warn_days * 86400), "warn")
    return out.withColumn("status", status.otherwise("pass"))


@dataclass(frozen=True)
class Check:
    """One data test. ``kind`` is the name of a function above."""

    kind: str
    column: str = ""
    values: tuple = ()
    columns: tuple = ()
    to: DataFrame | None = field(default=None, compare=False)
    field_name: str = ""
    expression: str = ""

    @property
    def name(self) -> str:
        target = self.column or "_".join(self.columns) or self.expression
        return f"{self.kind}:{target}"

    def row_condition(self):
        """Failing-row condition, for tests that one scan can count together."""
        c = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "expression_is_true":
            return ~F.expr(self.expression)
        return None

    def failures(self, df: DataFrame) -> DataFrame:
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "unique_combination":
            return unique_combination(df, self.columns)
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, self.values)
        if self.kind == "relationships":
            return relationships(df, self.column, self.to, self.field_name)
        raise ValueError(f"unknown check {self.kind}")


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per test: table, test, failures, status.

    Tests on single rows share one scan; the others group or join on their own key.
    """
    shared = [c for c in checks if c.row_condition() is not None]
    parts = []
    if shared:
        counts = [F.count_if(c.row_condition()).alias(f"f{i}") for i, c in enumerate(shared)]
        rows = F.array(*[
            F.struct(F.lit(c.name).alias("test_name"), F.col(f"f{i}").alias("failures"))
            for i, c in enumerate(shared)])
        parts.append(df.agg(*counts).select(F.inline(rows)))
    for c in checks:
        if c not in shared:
            parts.append(c.failures(df).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(c.name).alias("test_name"), "failures"))
    results = reduce(lambda a, b: a.unionByName(b), parts)
    return results.select(
        F.lit(table).alias("table_name"), "test_name", "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def pass_rate(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("tests_run"),
        F.count_if(F.col("status") == "pass").alias("tests_passed"),
        F.try_divide(F.count_if(F.col("status") == "pass").cast("double"),
                     F.count(F.lit(1)).cast("double")).alias("pass_rate"))
