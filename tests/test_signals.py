"""Signal arithmetic against numbers computed by hand, and the safety job on a small case set."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.operators.disproportionality import disproportionality
from tallyward.plans import safety

GOLDEN = [
    (10, 90, 100, 9800, 9.9, 5.328349, 18.394065, 65.514043, True),
    (3, 97, 150, 9750, 1.98, 0.642322, 6.103478, 0.630831, False),
    (3, 7, 1, 989, 297.0, 33.714738, 2616.333575, 153.431909, True),
    (5, 95, 495, 9405, 1.0, 0.423734, 2.359968, 0.0, False),
]


def screen(spark, a, b, c, d):
    pairs = spark.createDataFrame([("P", "R", a)], "product_id STRING, reaction_pt STRING, cases BIGINT")
    sizes = spark.createDataFrame([("P", a + b)], "product_id STRING, product_cases BIGINT")
    background = spark.createDataFrame([("R", a + c)], "reaction_pt STRING, cases_with_reaction BIGINT")
    return disproportionality(pairs, sizes, background, F.lit(a + b + c + d)).collect()


@pytest.mark.parametrize("a,b,c,d,prr,low,high,chi,signal", GOLDEN)
def test_golden(spark, a, b, c, d, prr, low, high, chi, signal):
    row = screen(spark, a, b, c, d)[0]
    assert row.prr == pytest.approx(prr, abs=1e-6)
    assert row.prr_lower_95 == pytest.approx(low, abs=1e-5)
    assert row.prr_upper_95 == pytest.approx(high, abs=1e-5)
    assert row.chi_square == pytest.approx(chi, abs=1e-5)
    assert row.is_signal is signal


@pytest.mark.parametrize("cells", [(4, 6, 0, 990), (2, 8, 10, 980)])
def test_rows_left_out(spark, cells):
    assert screen(spark, *cells) == []


def test_latest_and_attribution(spark):
    day = dt.date(2024, 1, 1)
    reports = spark.createDataFrame([
        ("1", "c1", 1, "q", day, False), ("2", "c1", 2, "q", day, True), ("3", "c2", None, "q", None, True),
        ("4", "c3", None, "q", day, False)],
        "primaryid STRING, caseid STRING, caseversion BIGINT, quarter STRING, fda_date DATE, is_owner_sender BOOLEAN")
    latest = safety.latest_cases(reports)
    assert {r.primaryid for r in latest.collect()} == {"2", "4"}
    drugs = spark.createDataFrame([
        ("1", 1, "PS", "A", None), ("2", 2, "PS", None, "G"), ("2", 1, "PS", "A", None), ("2", 3, "SS", "B", None),
        ("2", 5, "PS", "X", "A"), ("4", 1, "PS", None, "G"), ("4", None, "PS", "B", None)],
        "primaryid STRING, drug_seq BIGINT, role_cod STRING, drugname_key STRING, prod_ai_key STRING")
    aliases = spark.createDataFrame([("A", "P1", False), ("G", "P2", True), ("B", "P3", False)],
                                    "alias STRING, product_id STRING, requires_owner BOOLEAN")
    got = {(r.primaryid, r.product_id): (r.drug_seq, r.match_method)
           for r in safety.attributed_cases(drugs, latest, aliases).collect()}
    assert got == {("2", "P1"): (1, "drug name"), ("2", "P2"): (2, "active ingredient"), ("4", "P3"): (None, "drug name")}
