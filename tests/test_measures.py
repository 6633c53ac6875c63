"""Measure rules: blanks, prior periods, bases, shares and distinct counts."""

import pytest
from pyspark.sql import functions as F

from tallyward.plans.measures import Base, Formula, measure, registry


@pytest.fixture(scope="module")
def spend(spark):
    return spark.createDataFrame([
        ("a", 2020, 10.0, "x"), ("a", 2021, 30.0, "x"), ("a", 2023, 5.0, "x"), ("b", 2020, 0.0, "y"), ("b", 2021, 8.0, "y")],
        "brand STRING, year INT, spending_usd DOUBLE, portfolio_segment STRING")


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_growth_by_year(spend):
    got = by(measure(["spend_usd", "spend_usd_py", "spend_usd_yoy"], spend, ["brand", "year"]), "brand", "year")
    assert got["a", 2021].spend_usd_yoy == 2.0
    assert got["a", 2023].spend_usd_py is None and got["a", 2023].spend_usd_yoy is None
    assert got["b", 2021].spend_usd_py == 0.0 and got["b", 2021].spend_usd_yoy is None


def test_growth_of_a_selected_year_shows_groups_that_ended(spend):
    got = by(measure(["spend_usd", "spend_usd_py", "spend_usd_yoy"], spend, ["brand"], years=[2022]), "brand")
    assert (got["a",].spend_usd, got["a",].spend_usd_py, got["a",].spend_usd_yoy) == (None, 30.0, -1.0)
    with pytest.raises(ValueError):
        measure(["spend_usd_py"], spend, ["brand"])


def test_base_year_ignores_the_year_selection(spend):
    rows = by(measure(["spend_index", "spend_usd_m"], spend, ["brand", "year"], years=[2021]), "brand", "year")
    assert set(rows) == {("a", 2021), ("b", 2021)}
    assert rows["a", 2021].spend_index == 300.0 and rows["b", 2021].spend_index is None
    assert rows["a", 2021].spend_usd_m == pytest.approx(3e-5)
    total = measure(["spend_index"], spend, [], years=[2021]).first()
    assert total.spend_index == pytest.approx(380.0)


def test_share_keeps_year_and_drops_member_filters(spend):
    got = by(measure(["spend_share"], spend, ["brand", "year"], member_where=F.col("brand") == "a"), "brand", "year")
    assert got["a", 2021].spend_share == pytest.approx(30 / 38)
    flat = by(measure(["spend_share"], spend, ["brand"], years=[2021]), "brand")
    assert flat["b",].spend_share == pytest.approx(8 / 38)


def test_distinct_counts_and_blanks(spark):
    cases = spark.createDataFrame([
        ("p", "1", True), ("p", "1", True), ("p", "2", False), ("q", "1", True), ("q", "3", None), ("r", "4", False)],
        "product_id STRING, primaryid STRING, is_serious BOOLEAN")
    got = by(measure(["safety_cases", "serious_cases", "non_serious_cases", "serious_share", "home_safety_cases"],
                     cases, ["product_id"], where=F.col("product_id") != "z"), "product_id")
    assert (got["p",].safety_cases, got["p",].serious_cases, got["p",].non_serious_cases) == (2, 1, 1)
    assert got["r",].serious_cases is None and got["r",].non_serious_cases == 1 and got["r",].serious_share is None
    assert measure(["safety_cases"], cases).first().safety_cases == 4
    assert got["q",].home_safety_cases == 4


def test_zero_and_interval(spark):
    recalls = spark.createDataFrame([], "classification STRING")
    row = measure(["product_recalls", "class_1_recalls"], recalls).first()
    assert (row.product_recalls, row.class_1_recalls) == (0, 0)
    signals = spark.createDataFrame([("k1", "p", 1.234, 5.678), ("k2", "q", 1.0, 2.0), ("k3", "q", 3.0, 4.0)],
                                    "signal_key STRING, product_id STRING, prr_lower_95 DOUBLE, prr_upper_95 DOUBLE")
    got = by(measure(["prr_interval"], signals, ["product_id"]), "product_id")
    assert got["p",].prr_interval == "1.23 to 5.68" and got["q",].prr_interval is None


def test_any_year(spark):
    runs = spark.createDataFrame([("faers", 2023, 5, False), ("faers", 2024, 7, False), ("faers", 2024, 9, True), ("x", 2024, 1, False)],
                                 "source STRING, year INT, rows_loaded BIGINT, overlapped_previous_run BOOLEAN")
    assert measure(["main_source_records", "rows_ingested"], runs, [], years=[2024]).first().asDict() == {
        "main_source_records": 12, "rows_ingested": 8}
    got = by(measure(["main_source_records"], runs, ["source", "year"]), "source", "year")
    assert got["faers", 2023].main_source_records == 12


def test_every_formula_refers_to_known_measures():
    known = registry()
    for spec in known.values():
        assert isinstance(spec, Base) or all(name in known for name in spec.of)
        assert not isinstance(spec, Formula) or spec.kind in {
            "ratio", "minus", "prior", "at_year", "any_year", "share", "unfiltered", "same", "interval", "date_text"}
