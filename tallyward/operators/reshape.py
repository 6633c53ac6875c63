"""Unions, unpivots and calendars."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import calendar_columns


def union_programs(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns, whatever their order."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def members(*columns: tuple[DataFrame, str], name: str) -> DataFrame:
    """Distinct non-null values of several columns."""
    parts = [df.select(F.col(c).alias(name)) for df, c in columns]
    return reduce(lambda a, b: a.unionByName(b), parts).where(F.col(name).isNotNull()).distinct()


def discover_suffixes(df: DataFrame) -> list[str]:
    """Years that end a column name, from the schema alone."""
    return sorted({m.group(1) for c in df.columns if (m := re.search(r"_(\d{4})$", c))})


def unpivot_groups(df: DataFrame, ids: Sequence[Column | str], stems: Mapping[str, str],
                   years: Sequence[int | str], year: str = "year") -> DataFrame:
    """One row per input row and year from groups of ``<stem>_<year>`` columns, in one scan.

    ``stems`` maps the column stem to the output name. A column the input lacks is null.
    """
    have = set(df.columns)

    def cell(stem: str, y) -> Column:
        c = f"{stem}_{y}"
        return F.col(c) if c in have else F.lit(None).cast("string")

    rows = F.array(*[
        F.struct(F.lit(int(y)).cast("bigint").alias(year), *[cell(s, y).alias(n) for s, n in stems.items()])
        for y in years])
    return df.select(*ids, F.inline(rows))


def drop_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def where_matches(df: DataFrame, col: str, regex: str) -> DataFrame:
    """Rows whose upper-cased text matches the pattern."""
    return df.where(F.upper(F.col(col)).rlike(regex))


def slice_rows(df: DataFrame, keep: Mapping[str, Sequence] | None = None,
               drop: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Slicer filters: ``keep`` lists allowed values, ``drop`` lists values to leave out.

    A dropped list that holds ``None`` removes null rows as well; otherwise they stay.
    """
    for c, values in (keep or {}).items():
        df = df.where(F.col(c).isin(list(values)))
    for c, values in (drop or {}).items():
        known = [v for v in values if v is not None]
        unwanted = F.coalesce(F.col(c).isin(known), F.lit(None in values))
        df = df.where(~unwanted)
    return df


def search_all(df: DataFrame, regex: str, name: str = "row_json") -> DataFrame:
    """Rows whose JSON form matches the pattern in any column, ignoring case."""
    return df.withColumn(name, F.to_json(F.struct(*df.columns))).where(F.upper(name).rlike(regex))


def date_spine(bounds: DataFrame, first: str, last: str, name: str = "date_day") -> DataFrame:
    """Every day from ``first`` to the day before ``last`` of a one-row frame."""
    days = F.sequence(F.col(first), F.date_sub(F.col(last), 1))
    return bounds.where(F.col(first) < F.col(last)).select(F.explode(days).alias(name))


def date_dim(bounds: DataFrame, first: str = "start_date", last: str = "end_date") -> DataFrame:
    """The calendar with its attributes."""
    return date_spine(bounds, first, last).select("date_day", *calendar_columns("date_day"))
