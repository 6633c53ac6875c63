"""Calendar quarters as load units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quarter_label(date) -> Column:
    c = F.col(date) if isinstance(date, str) else date
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def quarter_labels(start, end) -> Column:
    """Array of labels of all quarters from the one of ``start`` to the one of ``end``."""
    s = F.trunc(F.col(start) if isinstance(start, str) else start, "quarter")
    e = F.trunc(F.col(end) if isinstance(end, str) else end, "quarter")
    steps = F.sequence(s, e, F.expr("interval 3 months"))
    return F.when(s <= e, F.transform(steps, quarter_label)).otherwise(F.array().cast("array<string>"))


def recent_quarter_labels(n: int, as_of) -> Column:
    """The ``n`` latest quarters completed before ``as_of``, oldest first."""
    current = F.trunc(F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of, "quarter")
    return quarter_labels(F.add_months(current, -3 * n), F.add_months(current, -3))


def quarter_start(label) -> Column:
    c = F.col(label) if isinstance(label, str) else label
    year = F.substring(c, 1, 4).cast("int")
    return F.make_date(year, (F.substring(c, 6, 1).cast("int") - 1) * 3 + 1, F.lit(1))


def quarter_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``('2025Q3', '2026Q1')`` to one row per quarter."""
    labels = quarter_labels(quarter_start(F.lit(start)), quarter_start(F.lit(end)))
    return spark.range(1).select(F.explode(labels).alias("quarter"))


def recent_quarters(spark: SparkSession, n: int, as_of: str) -> DataFrame:
    return spark.range(1).select(F.explode(recent_quarter_labels(n, as_of)).alias("quarter"))
