"""Partial dates, calendar parts and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def partial_date(col) -> Column:
    """``YYYYMMDD``, ``YYYYMM`` or ``YYYY`` text to a date; anything else is null."""
    c = _c(col)
    n = F.length(c)
    full = F.when(n == 8, c).when(n == 6, F.concat(c, F.lit("01"))).when(n == 4, F.concat(c, F.lit("0101")))
    return F.try_to_date(full, "yyyyMMdd")


def partial_iso_date(col) -> Column:
    """``YYYY-MM-DD``, ``YYYY-MM`` or ``YYYY`` text to a date; anything else is null."""
    c = _c(col)
    # What is padded to ten characters has this form only if it had it before, or lacked the day or month. No text gives
    # no date; a parser would throw an error for each.
    full = F.regexp_extract(F.rpad(c, 10, "-01-01"), "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$", 0)
    return F.when(F.length(c) <= 10, full.try_cast("date"))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def months_between_cal(start, end) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (days within the month do not count)."""
    s, e = _c(start), _c(end)
    months = (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))
    return months.cast("bigint")


def year_start(year) -> Column:
    return F.make_date(_c(year), F.lit(1), F.lit(1))


def day(ts) -> Column:
    return F.to_date(_c(ts))


def calendar_columns(d) -> list[Column]:
    """The calendar attributes of a date, aliased."""
    c = _c(d)
    return [
        F.year(c).cast("bigint").alias("year"),
        F.quarter(c).cast("bigint").alias("quarter_number"),
        F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string")).alias("year_quarter"),
        F.month(c).cast("bigint").alias("month_number"),
        F.date_format(c, "MMM").alias("month_name"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
        F.trunc(c, "month").alias("month_start"),
        F.weekofyear(c).cast("bigint").alias("iso_week"),
        F.date_format(c, "E").alias("weekday_name"),
    ]
