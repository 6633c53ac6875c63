"""Trial and recall marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import classify, due_within, label, months_between_cal
from tallyward.operators.dedup import first_with_count, latest_by
from tallyward.operators.reshape import members
from tallyward.operators.terms import match_or_search, match_terms
from tallyward.plans import rules


def study_products(studies: DataFrame, aliases: DataFrame) -> DataFrame:
    """Products named as whole words in the interventions of a study.

    Aliases with a backslash or parentheses are combination names and are skipped.
    """
    plain = aliases.where(~F.col("alias").rlike(r"[\\()]"))
    return match_terms(studies, "nct_id", "interventions", plain)


def primary_products(matched: DataFrame) -> DataFrame:
    """Longest match per study, with the number of products before the choice."""
    return first_with_count(
        matched, ["nct_id"], [-F.col("best_alias_length"), F.col("product_id")], ["product_id", "best_alias_length"],
        "product_count")


def clinical_trials(studies: DataFrame, matched: DataFrame, products: DataFrame, as_of: str,
                    no_product: str = "No marketed product", led: str = "Owner-led",
                    other: str = "Collaboration") -> DataFrame:
    """One row per study with product, area, durations and the readout flag at ``as_of``."""
    best = primary_products(matched).select("nct_id", F.col("product_id").alias("primary_product_id"), "product_count")
    dim = products.select(
        F.col("product_id").alias("primary_product_id"), "brand_name",
        F.col("therapeutic_area").alias("__area"))
    joined = studies.join(best, "nct_id", "left").join(dim, "primary_product_id", "left")
    text = F.concat(F.coalesce("mesh_terms", F.lit("")), F.lit(" "), F.coalesce("conditions", F.lit("")))
    finish = F.coalesce("primary_completion_date", "completion_date")
    return joined.select(
        "nct_id", "brief_title", "acronym", "primary_product_id",
        F.coalesce("brand_name", F.lit(no_product)).alias("primary_product_brand"),
        F.coalesce("product_count", F.lit(0)).cast("bigint").alias("product_count"),
        F.coalesce("__area", classify(text, rules.AREA_RULES)).alias("therapeutic_area"),
        "overall_status", "status_group", "why_stopped", "phase_group", "phase_sort", "study_type", "is_owner_led",
        F.when(F.col("is_owner_led"), led).otherwise(other).alias("sponsor_role"),
        "lead_sponsor", "start_date", "primary_completion_date", "completion_date", "last_update_post_date",
        F.year("start_date").cast("bigint").alias("start_year"),
        months_between_cal("start_date", finish).alias("planned_duration_months"),
        due_within("primary_completion_date", as_of, 12, F.col("status_group") == "Active")
        .alias("readout_next_12_months"),
        "enrollment_count", "enrollment_type", "country_count", "location_count", "has_results", "conditions",
        "snapshot_date")


def area_dimension(products: DataFrame, trials: DataFrame) -> DataFrame:
    """All areas of products and trials with their display order."""
    areas = members((products, "therapeutic_area"), (trials, "therapeutic_area"), name="therapeutic_area")
    return areas.withColumn("sort_order", label(
        "therapeutic_area", rules.AREA_ORDER, rules.AREA_ORDER_OTHER).cast("bigint"))


def recalls(staged: DataFrame, brand_aliases: DataFrame) -> DataFrame:
    """One row per recall with its product by first brand, else by the longest brand in the description.

    Of repeated numbers a row with a product comes first, then the one classified last.
    """
    found = match_or_search(staged, "recall_number", "brand_key", "product_description", brand_aliases)
    found = latest_by(found, ["recall_number"], [
        F.col("product_id").isNotNull().desc(), F.col("classification_date").desc_nulls_last(),
        F.col("recall_initiation_date").desc_nulls_last(), F.col("product_description"), F.col("product_id")])
    return found.select(
        "recall_number", "product_id", "classification", "status", "reason_category", "reason_for_recall",
        "product_description", "voluntary_mandated", "recall_initiation_date", "classification_date",
        "termination_date", F.year("recall_initiation_date").cast("bigint").alias("recall_year"))
