"""Column helpers on their edge cases."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyward import functions as fn
from tallyward.sources.periods import quarter_range, recent_quarters


def column(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def values(spark, items, dtype, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, c {dtype}")
    return [r[1] for r in rows.select("i", expr).orderBy("i").collect()]


def test_partial_date(spark):
    items = ["20240229", "202402", "2024", "2024022", "20241301", "", None, "abcd"]
    assert values(spark, items, "STRING", fn.partial_date("c")) == [
        dt.date(2024, 2, 29), dt.date(2024, 2, 1), dt.date(2024, 1, 1), None, None, None, None, None]


def test_partial_iso_date(spark):
    items = ["2024-02-29", "2024-02", "2024", "2023-02-29", "2024-2", None]
    assert values(spark, items, "STRING", fn.partial_iso_date("c")) == [
        dt.date(2024, 2, 29), dt.date(2024, 2, 1), dt.date(2024, 1, 1), None, None, None]


def test_iso_dates_of_odd_form(spark):
    items = ["0000-02-29", "2001-13-01", "2001-00-01", "2001-01-00", "2001-04-31", "2001-01-01\n", "2001-01-01-", "2001-01-", "2001-",
             "20010101", "2001-1-1", "2001-01-01T00", "+2001-01-0", " 2001-01-0", ""]
    first, *others = values(spark, items, "STRING", fn.partial_iso_date("c").cast("string"))
    assert first == "0000-02-29" and others == [None] * (len(items) - 1)


def test_clean_name(spark):
    items = ["Rituximab.", "x ..", "\ta b\t", "...", "", None, "a.b", " é. ", "x . .", "\xa0x.. .\n", "\u3000"]
    assert values(spark, items, "STRING", fn.clean_name("c")) == [
        "RITUXIMAB", "X", "A B", None, None, None, "A.B", "É", "X .", "X..", None]


def test_title_and_lists(spark):
    assert values(spark, [" drug INEFFECTIVE\t"], "STRING", fn.title("c")) == ["Drug Ineffective"]
    assert values(spark, ["a|b", "a", "", None], "STRING", fn.first_item("c")) == ["a", "a", "", None]
    assert values(spark, ["a|b", "a", "", None], "STRING", fn.item_count("c")) == [2, 1, 0, 0]


def test_join_distinct_keeps_first_seen_order(spark):
    items = [["b", "a", "b", "", None], [], [""], None]
    assert values(spark, items, "ARRAY<STRING>", fn.join_distinct("c")) == ["b|a", None, None, None]


def test_arrays(spark):
    items = [["A", None], ["DE"], [], None]
    assert values(spark, items, "ARRAY<STRING>", fn.has("c", "DE")) == [False, True, False, False]
    assert values(spark, items, "ARRAY<STRING>", fn.item_total("c")) == [2, 1, 0, 0]
    assert values(spark, items, "ARRAY<STRING>", fn.first_where("c", lambda x: x > "B")) == [None, "DE", None, None]


def test_safe_numbers(spark):
    assert values(spark, ["12", "12.5", "x", None], "STRING", fn.safe_cast("c", "bigint")) == [12, None, None, None]
    assert values(spark, [4.0, 0.0, None], "DOUBLE", fn.ratio(F.lit(2.0), "c")) == [0.5, None, None]
    assert values(spark, [1.0, 0.0, -1.0, None], "DOUBLE", fn.safe_ln("c")) == [0.0, None, None, None]
    assert values(spark, [4.0, -1.0], "DOUBLE", fn.safe_sqrt("c")) == [2.0, None]
    assert values(spark, [2**40, None], "BIGINT", fn.scan_cost("c")) == [6.25, None]


@pytest.mark.parametrize("unit,expected", [
    ("YR", 24.0), ("MON", 2.0), ("WK", 24 / 52), ("DY", 24 / 365), ("HR", 24 / 8760), ("DEC", 240.0), ("?", None), (None, None)])
def test_to_years(spark, unit, expected):
    assert values(spark, [unit], "STRING", fn.to_years(F.lit(24.0), "c")) == [expected]


def test_to_kg(spark):
    assert values(spark, ["KG", "LBS", "GMS", "", None], "STRING", fn.to_kg(F.lit(10.0), "c")) == [
        10.0, 4.53592, 0.01, None, None]


def test_cross_rate_needs_both(spark):
    assert column(spark, [(2.0, 1.0), (None, 1.0), (2.0, None)], "a DOUBLE, b DOUBLE", fn.cross_rate("a", "b")) == [
        (0.5,), (None,), (None,)]


def test_dates(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 1, 999999)
    assert column(spark, [(a, b)], "a TIMESTAMP, b TIMESTAMP", fn.seconds_between("a", "b")) == [(1,)]
    d = [(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2024, 12, 1), dt.date(2023, 11, 30))]
    assert column(spark, d, "a DATE, b DATE", fn.months_between_cal("a", "b")) == [(1,), (-13,)]
    assert values(spark, [2024, None], "INT", fn.year_start("c")) == [dt.date(2024, 1, 1), None]
    assert values(spark, [a], "TIMESTAMP", fn.day("c")) == [dt.date(2024, 1, 1)]


def test_calendar_uses_iso_weeks(spark):
    row = spark.createDataFrame([(dt.date(2021, 1, 3),)], "d DATE").select(*fn.calendar_columns("d")).first()
    assert (row.year, row.iso_week, row.weekday_name, row.month_name, row.year_quarter) == (2021, 53, "Sun", "Jan", "2021Q1")


def test_age_bands(spark):
    ages = [-1.0, 0.0, 17.9, 18.0, 74.9, 75.0, 120.0, 121.0, None]
    groups = fn.band("c", [18, 45, 65, 75], ["0-17", "18-44", "45-64", "65-74", "75+"], top=120)
    assert values(spark, ages, "DOUBLE", groups) == [
        "0-17", "0-17", "0-17", "18-44", "65-74", "75+", "75+", "Unknown", "Unknown"]
    assert values(spark, ages, "DOUBLE", fn.plausible("c", 0, 120))[0] is None


def test_labels_and_rules(spark):
    assert values(spark, ["A", "B", None], "STRING", fn.label("c", {"A": "x"}, "other")) == ["x", "other", "other"]
    rules = [("LABEL", "first"), ("PEN", "second")]
    assert values(spark, ["open label", "pending", "x", None], "STRING", fn.classify("c", rules)) == [
        "first", "second", "Other", "Other"]
    assert values(spark, ["Death", "product issue", "sudden death", None], "STRING",
                  fn.matches_terms("c", ["death"], "product ")) == [True, True, False, None]


def test_due_within(spark):
    d = [dt.date(2024, 1, 1), dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2023, 12, 31), None]
    assert values(spark, d, "DATE", fn.due_within("c", "2024-01-01", 12)) == [True, True, False, False, None]
    assert values(spark, d[:1] + [None], "DATE", fn.due_within("c", "2024-01-01", 12, F.lit(False))) == [False, False]


def test_surrogate_key_keeps_null_positions(spark):
    rows = column(spark, [("a", None), (None, "a"), ("a", "b")], "x STRING, y STRING", fn.surrogate_key("x", "y"))
    assert len({r[0] for r in rows}) == 3
    assert rows[2][0] == hashlib.md5(b"a-b").hexdigest()


def test_quarters(spark):
    labels = lambda df: sorted(r[0] for r in df.collect())
    assert labels(quarter_range(spark, "2025Q3", "2026Q1")) == ["2025Q3", "2025Q4", "2026Q1"]
    assert labels(quarter_range(spark, "2026Q2", "2026Q2")) == ["2026Q2"]
    assert labels(quarter_range(spark, "2026Q2", "2026Q1")) == []
    assert labels(recent_quarters(spark, 2, "2026-09-29")) == ["2026Q1", "2026Q2"]
    assert labels(recent_quarters(spark, 3, "2026-02-10")) == ["2025Q2", "2025Q3", "2025Q4"]
