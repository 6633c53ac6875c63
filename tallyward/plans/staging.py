"""Typed projections of the landed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import (
    classify,
    clean_name,
    first_item,
    item_count,
    label,
    partial_date,
    partial_iso_date,
    safe_cast,
    segment,
    title,
    to_kg,
    to_years,
    trim_all,
)
from tallyward.operators.reshape import drop_null, unpivot_groups
from tallyward.plans import rules


def _blank_to_null(name: str):
    return F.nullif(F.col(name), F.lit(""))


def stage_reports(df: DataFrame, owner_regex: str) -> DataFrame:
    """Report versions with dates, the sender flag, age in years and weight in kilograms."""
    return df.select(
        "primaryid", "caseid",
        safe_cast("caseversion", "bigint").alias("caseversion"), "quarter",
        partial_date("fda_dt").alias("fda_date"),
        partial_date("init_fda_dt").alias("init_fda_date"),
        partial_date("event_dt").alias("event_date"),
        F.col("rept_cod").alias("report_type"),
        F.upper(trim_all("mfr_sndr")).alias("sender"),
        F.coalesce(F.upper("mfr_sndr").rlike(owner_regex), F.lit(False)).alias("is_owner_sender"),
        _blank_to_null("occp_cod").alias("occp_cod"),
        _blank_to_null("reporter_country").alias("reporter_country"),
        _blank_to_null("occr_country").alias("occurrence_country"),
        _blank_to_null("sex").alias("sex"),
        to_years(safe_cast("age", "double"), "age_cod").alias("age_years"),
        to_kg(safe_cast("wt", "double"), "wt_cod").alias("weight_kg"))


def stage_drugs(df: DataFrame) -> DataFrame:
    return df.select(
        "primaryid", "caseid", safe_cast("drug_seq", "bigint").alias("drug_seq"), "role_cod",
        clean_name("drugname").alias("drugname_key"), clean_name("prod_ai").alias("prod_ai_key"),
        "route", "quarter")


def stage_terms(df: DataFrame, col: str, name: str, seq: str | None = None) -> DataFrame:
    """Title-cased terms; blank rows are removed."""
    extra = [safe_cast(seq, "bigint").alias("drug_seq")] if seq else []
    return df.where(trim_all(col) != "").select("primaryid", "caseid", *extra, title(col).alias(name), "quarter")


def stage_codes(df: DataFrame, col: str) -> DataFrame:
    return df.select("primaryid", "caseid", F.upper(trim_all(col)).alias(col), "quarter")


def stage_studies(df: DataFrame, owner_regex: str) -> DataFrame:
    """Studies with dates, status group, phase group and the sponsor flag."""
    phases = _blank_to_null("phases")
    status = F.col("overall_status")
    dates = ["start_date", "primary_completion_date", "completion_date", "first_post_date", "last_update_post_date"]
    return df.select(
        "nct_id", "brief_title", "acronym", "overall_status",
        segment([
            (status.isin(rules.ACTIVE_STATUS), "Active"),
            (status == "COMPLETED", "Completed"),
            (status.isin(rules.STOPPED_STATUS), "Stopped"),
        ], "Other").alias("status_group"),
        "why_stopped",
        *[partial_iso_date(d).alias(d) for d in dates],
        "lead_sponsor", "lead_sponsor_class", "collaborators",
        F.upper("lead_sponsor").rlike(owner_regex).alias("is_owner_led"),
        "study_type", phases.alias("phases"),
        label(phases, rules.PHASE_GROUPS, "Not applicable").alias("phase_group"),
        label(phases, rules.PHASE_SORT, 7).cast("bigint").alias("phase_sort"),
        "enrollment_count", "enrollment_type", "conditions", "keywords", "mesh_terms", "intervention_types",
        "interventions", "countries", item_count("countries").alias("country_count"), "location_count",
        "has_results", "snapshot_date")


def stage_recalls(df: DataFrame, reasons: Sequence[tuple[str, str]] = tuple(rules.RECALL_REASONS)) -> DataFrame:
    """Recalls with dates, the first matching reason category and the first brand as key."""
    return df.select(
        "recall_number", "event_id", "status", "classification", "recalling_firm", "product_description",
        "reason_for_recall", classify("reason_for_recall", reasons).alias("reason_category"),
        "voluntary_mandated", "distribution_pattern",
        partial_date("recall_initiation_date").alias("recall_initiation_date"),
        partial_date("center_classification_date").alias("classification_date"),
        partial_date("termination_date").alias("termination_date"),
        clean_name(first_item(F.coalesce("brand_names", F.lit("")))).alias("brand_key"),
        "brand_names", "generic_names")


# The column groups of the wide spending files.
SPENDING_STEMS = {
    "Tot_Spndng": "total_spending_usd", "Tot_Dsg_Unts": "dosage_units", "Tot_Clms": "claims",
    "Tot_Benes": "beneficiaries", "Outlier_Flag": "is_outlier",
}


def stage_spending(df: DataFrame, program: str, years: Sequence[int | str],
                   ids: Mapping[str, str | None]) -> DataFrame:
    """One row per drug and year from the wide file, from a single scan.

    ``ids`` maps output columns to source columns (or None where the file has none);
    stars and outer whitespace are dropped from them.
    """
    columns = [
        (trim_all(F.replace(F.col(src), F.lit("*"), F.lit(""))) if src else F.lit(None).cast("string")).alias(out)
        for out, src in ids.items()]
    long = unpivot_groups(df, columns, SPENDING_STEMS, years)
    numbers = ["total_spending_usd", "dosage_units", "claims", "beneficiaries"]
    typed = long.withColumns({
        **{c: safe_cast(c, "decimal(38,9)") for c in numbers}, "is_outlier": F.col("is_outlier") == "1"})
    return drop_null(typed, "total_spending_usd").select(
        F.lit(program).alias("program"), clean_name("brand_name").alias("brand_key"), *typed.columns)


def stage_fx(df: DataFrame) -> DataFrame:
    return drop_null(df.select("rate_date", "currency", "base_currency", "rate"), "rate")
