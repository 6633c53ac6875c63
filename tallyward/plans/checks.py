"""The data tests of the standard tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tallyward.operators.quality import Check, run_checks


def _key(*columns: str) -> list[Check]:
    return [Check(kind, c) for c in columns for kind in ("unique", "not_null")]


def _product(products: DataFrame, column: str = "product_id") -> Check:
    return Check("relationships", column, to=products, field_name="product_id")


def standard_checks(products: DataFrame) -> dict[str, list[Check]]:
    """Tests per table. ``products`` is the product list that facts refer to."""
    return {
        "products": [*_key("product_id", "brand_name"), Check("not_null", "therapeutic_area")],
        "aliases": [*_key("alias"), Check("not_null", "product_id"), _product(products),
                    Check("accepted_values", "alias_type", values=("brand", "molecule"))],
        "studies": [*_key("nct_id"), Check(
            "accepted_values", "status_group", values=("Active", "Completed", "Stopped", "Other"))],
        "part_d_spending": [Check("expression_is_true", expression="total_spending_usd >= 0")],
        "staged_recalls": _key("recall_number"),
        "stream_events": _key("event_id"),
        "latest_cases": _key("caseid", "primaryid"),
        "attributed_cases": [Check("unique_combination", columns=("primaryid", "product_id")),
                             Check("not_null", "product_id"), _product(products)],
        "event_background": _key("reaction_pt"),
        "cross_rates": _key("rate_date"),
        "product_indications": [Check("unique_combination", columns=("product_id", "indication_pt"))],
        "dim_product": _key("product_id"),
        "dim_date": _key("date_day"),
        "dim_area": _key("therapeutic_area"),
        "yearly_spending": [*_key("spending_key"), _product(products),
                            Check("accepted_values", "program", values=("Part B", "Part D"))],
        "clinical_trials": [*_key("nct_id"), Check("not_null", "therapeutic_area"),
                            _product(products, "primary_product_id")],
        "safety_cases": [*_key("safety_case_key"), Check("not_null", "product_id"), _product(products)],
        "safety_signals": [*_key("signal_key"), Check("not_null", "is_reportable_signal"),
                           Check("expression_is_true", expression="prr > 0")],
        "recalls": _key("recall_number"),
        "intake_events": _key("event_id"),
        "ingestion_runs": _key("run_id"),
    }


# Age limits of the loaded sources in days: warn, error.
FRESHNESS_DAYS = {"stream_events": (30, None), "ingestion_runs": (2, 7)}


def check_tables(tables: Mapping[str, DataFrame], products: DataFrame) -> DataFrame:
    """Results of the standard tests for the tables given."""
    suite = standard_checks(products)
    return reduce(DataFrame.unionByName, [run_checks(df, name, suite[name]) for name, df in tables.items()])

