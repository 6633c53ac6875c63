"""Report queries: measures with their filters, top-n choice and order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.aggregates import matrix
from tallyward.operators.joins import restrict_to
from tallyward.operators.ranking import sort_by_column, top_n
from tallyward.operators.reshape import slice_rows
from tallyward.plans.measures import Base, Formula, measure, registry

Measures = Mapping[str, Base | Formula] | None


def top_brands(spending: DataFrame, years: Sequence[int], n: int = 10, brand: str = "brand_name",
               measures: Measures = None) -> DataFrame:
    """Brands with the highest spend, with growth on the year before."""
    per_brand = measure(["spend_usd", "spend_usd_yoy"], spending, [brand], years=years, measures=measures)
    return top_n(per_brand, "spend_usd", n).orderBy(F.col("spend_usd").desc(), brand)


def area_share(spending: DataFrame, years: Sequence[int], n: int = 10, brand: str = "brand_name",
               area: str = "therapeutic_area", measures: Measures = None) -> DataFrame:
    """Share of total spend per area, counting only the top brands above the line."""
    brands = top_n(measure(["spend_usd"], spending, [brand], years=years, measures=measures), "spend_usd", n)
    kept = restrict_to(spending, brands.select(brand), brand)
    per_area = measure(["spend_usd", "spend_usd_yoy"], kept, [area], years=years, measures=measures)
    total = measure(["spend_usd"], spending, [], years=years, measures=measures).scalar()
    share = F.try_divide(F.col("spend_usd").cast("double"), total.cast("double"))
    return (
        per_area.where(F.col("spend_usd").isNotNull()).withColumn("spend_share", share)
        .orderBy(F.col("spend_share").desc(), area)
    )


def spend_by_segment(spending: DataFrame, dropped_years: Sequence[int | None] = (), segment: str = "portfolio_segment",
                     measures: Measures = None) -> DataFrame:
    """Spend and spend index per year and segment, without the listed years."""
    rows = measure(["spend_usd", "spend_index"], spending, ["year", segment], measures=measures)
    return slice_rows(rows, drop={"year": dropped_years}).orderBy("year", segment)


def serious_per_quarter(cases: DataFrame, years: Sequence[int]) -> DataFrame:
    kept = slice_rows(cases, keep={"year": years})
    return measure(["serious_cases", "non_serious_cases"], kept, ["year_quarter"]).orderBy("year_quarter")


OUTCOME_MEASURES = ["any_serious_outcome", "hospitalisation_cases", "life_threatening_cases", "fatal_cases"]


def outcome_totals(cases: DataFrame) -> DataFrame:
    """The outcome measures as rows, highest first."""
    one = measure(OUTCOME_MEASURES, cases)
    rows = F.array(*[F.struct(F.lit(m).alias("outcome"), F.col(m).alias("cases")) for m in OUTCOME_MEASURES])
    return one.select(F.inline(rows)).orderBy(F.col("cases").desc(), "outcome")


def cases_by_age_and_sex(cases: DataFrame, sexes: Sequence[str] = ("F", "M")) -> DataFrame:
    kept = slice_rows(cases, keep={"sex": sexes})
    return measure(["safety_cases"], kept, ["age_group", "sex"]).orderBy("age_group", "sex")


def reporter_countries(cases: DataFrame, n: int = 8) -> DataFrame:
    per_country = measure(["safety_cases"], cases.where(F.col("reporter_country").isNotNull()), ["reporter_country"])
    return top_n(per_country, "safety_cases", n).orderBy(F.col("safety_cases").desc(), "reporter_country")


def reportable_signals(signals: DataFrame, brand: str = "brand_name") -> DataFrame:
    """Reportable signals with their confidence interval as text, by number of cases."""
    kept = signals.where("is_reportable_signal")
    grouped = measure(
        ["cases", "prr_sum", "prr_interval"], kept, [brand, "reaction_pt"], measures={
            **registry(), "cases": Base("sum", "cases_product_reaction"), "prr_sum": Base("sum", "prr")})
    return grouped.withColumnRenamed("prr_sum", "prr").orderBy(F.col("cases").desc(), brand, "reaction_pt")


def active_by_phase(trials: DataFrame, hidden: str = "Not applicable") -> DataFrame:
    """Active trials per phase, in phase order."""
    kept = trials.where(F.col("phase_group") != hidden)
    return sort_by_column(measure(["active_trials"], kept, ["phase_group", "phase_sort"]), "phase_group", "phase_sort")


def area_by_phase(trials: DataFrame, phases: Sequence[str], area: str = "therapeutic_area") -> DataFrame:
    """Active trials by area and phase with totals."""
    active = trials.where("is_owner_led AND status_group = 'Active'")
    return matrix(active, area, "phase_group", phases)


def starts_by_status(trials: DataFrame, years: Sequence[int]) -> DataFrame:
    kept = slice_rows(trials, keep={"start_year": years})
    return measure(["owner_led_trials"], kept, ["start_year", "status_group"]).orderBy("start_year", "status_group")


def upcoming_readouts(trials: DataFrame, hidden: str = "Not applicable") -> DataFrame:
    """Owner-led trials that read out in the next twelve months, by date."""
    kept = trials.where("readout_next_12_months AND is_owner_led").where(F.col("phase_group") != hidden)
    return kept.select(
        "primary_completion_date", "nct_id", "brief_title", "primary_product_brand", "phase_group",
        "enrollment_count").orderBy("primary_completion_date", "nct_id")


def runs_by_source(runs: DataFrame) -> DataFrame:
    return measure(["ingestion_runs", "rows_ingested", "overlapping_runs"], runs, ["source", "status"]).orderBy(
        F.col("ingestion_runs").desc(), "source", "status")


def batches_over_time(batches: DataFrame, at: str = "batch_ts") -> DataFrame:
    names = ["stream_valid", "stream_invalid", "stream_max_lag", "stream_avg_throughput"]
    return measure(names, batches, [at]).orderBy(at)


def layer_table(volumes: DataFrame) -> DataFrame:
    return measure(["layer_rows", "layer_size_mb"], volumes, ["layer", "table_id"]).orderBy("layer", "table_id")
