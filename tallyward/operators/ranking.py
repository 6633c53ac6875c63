"""Ranks, top-n and prior-period values that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.joins import null_safe, restrict_to


def rank_in(df: DataFrame, by: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """``rank()`` by descending value within each group.

    A row's rank is one more than the rows above it, so the window runs over the counts
    of distinct values and the result is joined back. For counts a group has few
    distinct values however many rows it holds.
    """
    above = Window.partitionBy(*by).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    tally = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    ranks = tally.select(
        *[F.col(c).alias(f"__{c}") for c in (*by, value)],
        (F.coalesce(F.sum("__n").over(above), F.lit(0)) + 1).cast("bigint").alias(name))
    on = null_safe([*by, value], [f"__{c}" for c in (*by, value)])
    return df.join(ranks, on, "inner").drop(*[f"__{c}" for c in (*by, value)])


def top_n(df: DataFrame, measure: str, n: int) -> DataFrame:
    """Rows of an aggregate whose measure is among the ``n`` highest, ties kept.

    Spark cuts each task's rows to its own ``n`` ranks before the exchange, so the window
    that spans the rest sees few rows, and ``df`` is computed once. A null measure does
    not rank.
    """
    ranked = df.where(F.col(measure).isNotNull()).withColumn(
        "__rank", F.rank().over(Window.orderBy(F.col(measure).desc())))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def top_n_filter(df: DataFrame, by: str, measure: Column, n: int) -> DataFrame:
    """Detail rows that belong to the top ``n`` members of ``by``."""
    members = top_n(df.groupBy(by).agg(measure.alias("__m")), "__m", n)
    return restrict_to(df, members.select(by), by)


def head_by_count(df: DataFrame, col: str, n: int, name: str = "n") -> DataFrame:
    """The ``n`` most frequent values; equal counts by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), F.col(col)).limit(n)


def sort_by_column(df: DataFrame, label: str, sort: str) -> DataFrame:
    """Order labels by their sort position."""
    return df.orderBy(F.col(sort).asc_nulls_last(), F.col(label).asc_nulls_last())


def stable_sort(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.orderBy(*columns)


def prior_period(df: DataFrame, group: Sequence[str], period: str, value: str, name: str,
                 include_gone: bool = False) -> DataFrame:
    """Value of the period before, per group, for an aggregate with one row per group and period.

    A missing period gives null (not the last one seen). ``include_gone`` also returns
    the period after a group's last one, where only the prior value exists.
    """
    if not include_gone:
        w = Window.partitionBy(*group).orderBy(period).rangeBetween(-1, -1)
        return df.withColumn(name, F.sum(value).over(w))
    shifted = df.select(*group, (F.col(period) + 1).cast(df.schema[period].dataType).alias(period),
                        F.col(value).alias(name))
    return df.join(shifted, [*group, period], "full_outer")
