"""Safety marts: latest cases, attributed cases, case profiles and signals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import band, label, matches_terms, plausible, surrogate_key
from tallyward.operators.aggregates import (
    any_flag,
    case_counts,
    codes_text,
    group_cases,
    pair_counts,
    share_of_total,
    total_cases,
)
from tallyward.operators.attribution import match_names
from tallyward.operators.dedup import latest_by
from tallyward.operators.disproportionality import disproportionality
from tallyward.operators.joins import enrich, join_items, join_latest, restrict_to
from tallyward.operators.ranking import rank_in
from tallyward.operators.reshape import drop_null
from tallyward.operators.terms import exists_substring
from tallyward.plans import rules


def latest_cases(reports: DataFrame) -> DataFrame:
    """The latest version of every case; reports without a date do not compete."""
    slim = drop_null(reports, "fda_date").select(
        "primaryid", "caseid", "caseversion", "quarter", "fda_date", "is_owner_sender")
    return latest_by(slim, ["caseid"], [
        F.col("caseversion").desc_nulls_last(), F.col("fda_date").desc(), F.col("primaryid").desc()])


def attributed_cases(drugs: DataFrame, latest: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per latest case and product named as its primary suspect.

    Names are matched before cases are joined, so only rows of known products are
    shuffled; repeated rows collapse to their lowest sequence on the way.
    """
    suspects = drugs.where(F.col("role_cod") == "PS").select("primaryid", "drug_seq", "drugname_key", "prod_ai_key")
    candidates = (
        match_names(suspects, aliases, "drugname_key", "prod_ai_key")
        .groupBy("primaryid", "product_id", "drugname_key", "prod_ai_key", "match_method", "requires_owner")
        .agg(F.min("drug_seq").alias("drug_seq"))
    )
    kept = join_latest(candidates, latest.select("primaryid", "is_owner_sender"), "primaryid").where(
        ~F.col("requires_owner") | F.col("is_owner_sender"))
    first = latest_by(kept, ["primaryid", "product_id"], [
        F.col("drug_seq").asc_nulls_last(), F.col("drugname_key").asc_nulls_last(),
        F.col("prod_ai_key").asc_nulls_last()])
    return first.select(
        "primaryid", "product_id", "drug_seq", "drugname_key", "prod_ai_key", "match_method", "is_owner_sender")


def product_indications(indications: DataFrame, attributed: DataFrame,
                        min_share: float = rules.MIN_INDICATION_SHARE) -> DataFrame:
    """Indications of the suspect drug that make up at least ``min_share`` of a product's cases."""
    specific = indications.where(~F.col("indication_pt").isin(rules.UNSPECIFIC_INDICATIONS)).select(
        "primaryid", "drug_seq", "indication_pt")
    matched = join_items(attributed.select("primaryid", "drug_seq", "product_id"), specific, ["primaryid", "drug_seq"])
    return share_of_total(matched, attributed, "product_id", "indication_pt", "primaryid", min_share)


def safety_signals(reactions: DataFrame, latest: DataFrame, attributed: DataFrame, indications: DataFrame,
                   min_cases: int = rules.MIN_CASES, threshold: float = rules.PRR_THRESHOLD,
                   chi: float = rules.CHI_THRESHOLD, min_share: float = rules.MIN_INDICATION_SHARE,
                   keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """Disproportionality of every product and reaction with the review flags.

    ``latest`` and ``attributed`` are read more than once: pass written tables. ``keep``
    writes what the screen itself reads more than once: the reactions of each case and
    the statistics of the pairs.
    """
    reported = keep(restrict_to(reactions.select("primaryid", "reaction_pt"), latest.select("primaryid"), "primaryid"),
                    "reported_reactions")
    pairs = pair_counts(attributed, reported, "primaryid", "product_id", "reaction_pt")
    background = case_counts(reported, "primaryid", "reaction_pt")
    sizes = group_cases(attributed, "product_id", "primaryid", "product_cases")
    stats = keep(disproportionality(
        pairs, sizes, background, total_cases(latest).scalar(), "product_id", "reaction_pt", min_cases, threshold, chi),
        "pair_statistics")
    terms = product_indications(indications, attributed, min_share)
    ranked = rank_in(stats, ["product_id"], "cases_product_reaction", "rank_by_cases")
    flagged = exists_substring(ranked, terms, "product_id", "indication_pt", "reaction_pt", "is_indication_related")
    flagged = flagged.withColumn("is_non_clinical_term", matches_terms(
        "reaction_pt", rules.NON_CLINICAL_EXACT, rules.NON_CLINICAL_CONTAINS))
    return flagged.select(
        surrogate_key("product_id", "reaction_pt").alias("signal_key"),
        *[c for c in stats.columns], "is_indication_related", "is_non_clinical_term", "rank_by_cases",
        (F.col("is_signal") & ~F.col("is_indication_related") & ~F.col("is_non_clinical_term"))
        .alias("is_reportable_signal"))


def safety_cases(reports: DataFrame, outcomes: DataFrame, reactions: DataFrame, attributed: DataFrame,
                 occupations: DataFrame, deadly: str = rules.DEATH, threatening: str = rules.LIFE_THREATENING,
                 hospital: str = rules.HOSPITALISATION) -> DataFrame:
    """One row per attributed case with patient profile, outcomes and reaction count."""
    ids = attributed.select("primaryid")
    demo = latest_by(restrict_to(reports, ids, "primaryid"), ["primaryid"], [
        F.col("quarter").desc_nulls_last(), F.col("fda_date").desc_nulls_last(),
        F.col("caseversion").desc_nulls_last()])
    codes = restrict_to(outcomes, ids, "primaryid").groupBy("primaryid").agg(
        codes_text("outc_cod").alias("outcome_codes"),
        any_flag("outc_cod", deadly).alias("is_death"),
        any_flag("outc_cod", threatening).alias("is_life_threatening"),
        any_flag("outc_cod", hospital).alias("is_hospitalisation"))
    counts = group_cases(restrict_to(reactions, ids, "primaryid"), "primaryid", "reaction_pt", "reaction_count")

    cases = attributed.select("primaryid", "product_id", "match_method").join(demo, "primaryid", "inner")
    cases = enrich(cases, codes, "primaryid", {
        "is_death": False, "is_life_threatening": False, "is_hospitalisation": False})
    cases = enrich(cases, counts, "primaryid", {"reaction_count": 0})
    cases = enrich(cases, occupations, "occp_cod", {"reporter_type": "Unknown", "is_health_professional": False})
    age = F.col("age_years")
    return cases.select(
        surrogate_key("primaryid", "product_id").alias("safety_case_key"),
        "primaryid", "caseid", "caseversion", "product_id", "match_method", "quarter", "fda_date",
        "init_fda_date", "event_date", "report_type",
        label("report_type", rules.REPORT_TYPES, "Other").alias("report_type_label"),
        "is_owner_sender", "reporter_type",
        F.col("is_health_professional").alias("is_health_professional_report"),
        "reporter_country", "occurrence_country", "sex",
        plausible(age, 0, 120).alias("age_years"),
        band(age, rules.AGE_EDGES, rules.AGE_LABELS, top=120).alias("age_group"),
        plausible("weight_kg", 1, 350).alias("weight_kg"),
        "outcome_codes", F.col("outcome_codes").isNotNull().alias("is_serious"),
        "is_death", "is_life_threatening", "is_hospitalisation", "reaction_count")


def safety_layers(reports: DataFrame, drugs: DataFrame, aliases: DataFrame,
                  keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """Latest and attributed cases; ``keep`` writes each layer that later jobs share."""
    latest = keep(latest_cases(reports), "latest_cases")
    return latest, keep(attributed_cases(drugs, latest, aliases), "attributed_cases")
