"""Measures and report queries on the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.gallery import Tables, query
from tallyward.gallery.readings import RECALLS_SQL, RUNS_SQL, SEEDS_SQL, products, runs
from tallyward.gallery.readings import reports as reports_of
from tallyward.gallery.safety import CASES_SQL, SIGNALS_SQL, cases, signals
from tallyward.gallery.spending import SPENDING_SQL, mart
from tallyward.gallery.trials import TRIALS_SQL, marts
from tallyward.gallery.trials import recalls as recall_mart
from tallyward.operators.joins import star
from tallyward.operators.reshape import date_dim
from tallyward.plans import reports
from tallyward.plans.checks import check_tables
from tallyward.plans.measures import measure, registry
from tallyward.plans.observability import run_results
from tallyward.plans.safety import latest_cases
from tallyward.plans.spending import product_dimension

BASE_YEAR = 1996
YEARS = [2000]
MEASURES = registry(base_year=BASE_YEAR)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and decimals as doubles, for the comparison by value."""
    out = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "double" or kind.startswith("decimal"):
            out[f.name] = F.round(F.col(f.name).cast("double"), digits)
    return df.withColumns(out) if out else df


def spend_fact(t: Tables) -> DataFrame:
    dims = {"product": product_dimension(products(t))}
    return star(mart(t), dims, [("product_id", "product", "product_id", True)])


@query("spend_growth", f"""{SPENDING_SQL}, y AS (
  SELECT brand_name, year, sum(spending_usd) AS u, sum(spending_chf) AS c, sum(claims) AS n FROM spend GROUP BY 1, 2)
SELECT coalesce(y.brand_name, p.brand_name) AS brand_name, coalesce(y.year, p.year + 1) AS year, round(y.u, 2) AS spend_usd,
  round(p.u, 2) AS spend_usd_py, round((coalesce(y.u, 0) - p.u) / nullif(p.u, 0), 6) AS spend_usd_yoy, round(y.c, 2) AS spend_chf,
  round(p.c, 2) AS spend_chf_py, round((coalesce(y.c, 0) - p.c) / nullif(p.c, 0), 6) AS spend_chf_yoy,
  CAST(y.n AS DOUBLE) AS medicare_claims, CAST(p.n AS DOUBLE) AS medicare_claims_py,
  round((coalesce(y.n, 0) - p.n) / nullif(p.n, 0), 6) AS medicare_claims_yoy, round(y.u / 1000000, 6) AS spend_usd_m
FROM y FULL JOIN y p ON p.brand_name = y.brand_name AND p.year = y.year - 1
WHERE coalesce(y.year, p.year + 1) IN (SELECT year FROM y)""")
def spend_growth(t: Tables) -> DataFrame:
    names = ["spend_usd", "spend_usd_py", "spend_usd_yoy", "spend_chf", "spend_chf_py", "spend_chf_yoy",
             "medicare_claims", "medicare_claims_py", "medicare_claims_yoy", "spend_usd_m"]
    out = _rounded(measure(names, spend_fact(t), ["brand_name", "year"]))
    return out.withColumns({c: F.round(c, 2) for c in ("spend_chf", "spend_chf_py")})


@query("growth_brands", f"""{SPENDING_SQL}, y AS (
  SELECT year, sum(spending_usd) AS u, sum(spending_usd) FILTER (portfolio_segment = 'Growth (launched 2016+)') AS g
  FROM spend GROUP BY 1)
SELECT y.year, round(y.g, 6) AS spend_growth_brands, round(y.g / y.u, 6) AS growth_brands_share,
  round(p.g / p.u, 6) AS growth_brands_share_py,
  round((y.g / y.u - coalesce(p.g / p.u, 0)) * 100, 6) AS growth_brands_share_change
FROM y LEFT JOIN y p ON p.year = y.year - 1""")
def growth_brands(t: Tables) -> DataFrame:
    names = ["spend_growth_brands", "growth_brands_share", "growth_brands_share_py", "growth_brands_share_change"]
    return _rounded(measure(names, spend_fact(t), ["year"]))


@query("index_base", f"""{SPENDING_SQL}, y AS (
  SELECT portfolio_segment, year, sum(spending_usd) AS u,
    sum(spending_usd) FILTER (portfolio_segment = 'Loss of exclusivity') AS l FROM spend GROUP BY 1, 2)
SELECT y.portfolio_segment, y.year, round(y.l, 6) AS spend_loe, round(b.l, 6) AS spend_loe_base,
  round(y.l / b.l - 1, 6) AS loe_erosion, round(y.u / b.u * 100, 6) AS spend_index
FROM y LEFT JOIN y b ON b.portfolio_segment = y.portfolio_segment AND b.year = {BASE_YEAR}""")
def index_base(t: Tables) -> DataFrame:
    names = ["spend_loe", "spend_loe_base", "loe_erosion", "spend_index"]
    return _rounded(measure(names, spend_fact(t), ["portfolio_segment", "year"], measures=MEASURES))


@query("share_total", f"""{SPENDING_SQL}
SELECT therapeutic_area, program, round(sum(spending_usd) FILTER (year = 2000), 6) AS spend_usd,
  round(sum(spending_usd) FILTER (year = 2000) / (SELECT sum(s.spending_usd) FROM spend s
    WHERE s.program = spend.program AND s.year = 2000), 6) AS spend_share
FROM spend WHERE portfolio_segment != 'Established' GROUP BY 1, 2""")
def share_total(t: Tables) -> DataFrame:
    return _rounded(measure(
        ["spend_usd", "spend_share"], spend_fact(t), ["therapeutic_area", "program"],
        member_where=F.col("portfolio_segment") != "Established", years=YEARS))


@query("growth_selected_year", f"""{SPENDING_SQL}
SELECT brand_name, round(sum(spending_usd) FILTER (year = 2000), 6) AS spend_usd,
  round(sum(spending_usd) FILTER (year = 1999), 6) AS spend_usd_py,
  round(sum(spending_usd) FILTER (year = 2000) / sum(spending_usd) FILTER (year = 1999) - 1, 6) AS spend_usd_yoy
FROM spend GROUP BY 1""")
def growth_selected_year(t: Tables) -> DataFrame:
    return _rounded(measure(["spend_usd", "spend_usd_py", "spend_usd_yoy"], spend_fact(t), ["brand_name"], years=YEARS))


TRIAL_MEASURES = [
    "trials", "home_trials", "owner_led_trials", "active_trials", "recruiting_trials", "completed_trials", "stopped_trials",
    "stopped_early_rate", "active_phase3_trials", "phase3_share_of_active", "readouts_next_12m",
    "readouts_next_12m_phase3", "patients_in_active_trials", "avg_enrollment_active"]


@query("trial_measures", f"""{TRIALS_SQL}, f AS (
  SELECT phase_group, count(*) AS trials, count(*) FILTER (is_owner_led) AS owner_led_trials,
    count(*) FILTER (is_owner_led AND status_group = 'Active') AS active_trials,
    count(*) FILTER (is_owner_led AND overall_status = 'RECRUITING') AS recruiting_trials,
    count(*) FILTER (is_owner_led AND status_group = 'Completed') AS completed_trials,
    count(*) FILTER (is_owner_led AND status_group = 'Stopped') AS stopped_trials,
    nullif(count(*) FILTER (is_owner_led AND status_group = 'Active' AND phase_group IN ('Phase 3', 'Phase 2/3')), 0)
      AS active_phase3_trials,
    nullif(count(*) FILTER (is_owner_led AND readout_next_12_months), 0) AS readouts_next_12m,
    nullif(count(*) FILTER (is_owner_led AND readout_next_12_months AND phase_group IN ('Phase 3', 'Phase 2/3')), 0)
      AS readouts_next_12m_phase3,
    CAST(sum(enrollment_count) FILTER (is_owner_led AND status_group = 'Active') AS BIGINT) AS patients_in_active_trials
  FROM trials GROUP BY 1)
SELECT *, (SELECT count(*) FROM trials) AS home_trials,
  round(stopped_trials / nullif(stopped_trials + completed_trials, 0), 6) AS stopped_early_rate,
  round(active_phase3_trials / active_trials, 6) AS phase3_share_of_active,
  round(patients_in_active_trials / active_trials, 6) AS avg_enrollment_active FROM f""")
def trial_measures(t: Tables) -> DataFrame:
    return _rounded(measure(TRIAL_MEASURES, marts(t), ["phase_group"]))


def case_fact(t: Tables) -> DataFrame:
    """Safety cases with calendar columns, written."""
    day = F.to_date("o_orderdate")
    bounds = t.orders.agg(F.trunc(F.min(day), "year").alias("start_date"), F.date_add(F.max(day), 1).alias("end_date"))
    dims = {"date": date_dim(bounds)}
    return t.layer("safety_cases", lambda: star(cases(t), dims, [("fda_date", "date", "date_day", True)]))


_CASE_COUNTS = """
  count(DISTINCT primaryid) AS safety_cases, nullif(count(DISTINCT primaryid) FILTER (is_serious), 0) AS serious_cases,
  count(DISTINCT primaryid) - count(DISTINCT primaryid) FILTER (is_serious) AS non_serious_cases,
  nullif(count(DISTINCT primaryid) FILTER (is_death), 0) AS fatal_cases,
  nullif(count(DISTINCT primaryid) FILTER (is_life_threatening), 0) AS life_threatening_cases,
  nullif(count(DISTINCT primaryid) FILTER (is_hospitalisation), 0) AS hospitalisation_cases,
  nullif(count(DISTINCT primaryid) FILTER (is_health_professional_report), 0) AS hcp_reported_cases"""


@query("safety_measures", f"""{CASES_SQL}, f AS (SELECT product_id, {_CASE_COUNTS} FROM cases GROUP BY 1)
SELECT *, serious_cases AS any_serious_outcome, (SELECT count(DISTINCT primaryid) FROM cases) AS home_safety_cases,
  round(serious_cases / safety_cases, 6) AS serious_share, round(fatal_cases / safety_cases, 6) AS fatal_share,
  round(hcp_reported_cases / safety_cases, 6) AS hcp_reported_share FROM f""")
def safety_measures(t: Tables) -> DataFrame:
    names = ["safety_cases", "serious_cases", "non_serious_cases", "fatal_cases", "life_threatening_cases",
             "hospitalisation_cases", "hcp_reported_cases", "any_serious_outcome", "home_safety_cases", "serious_share",
             "fatal_share", "hcp_reported_share"]
    return _rounded(measure(names, case_fact(t), ["product_id"]))


@query("safety_growth", f"""{CASES_SQL}, y AS (
  SELECT product_id, year(fda_date) AS year, count(DISTINCT primaryid) AS n FROM cases GROUP BY 1, 2)
SELECT coalesce(y.product_id, p.product_id) AS product_id, coalesce(y.year, p.year + 1) AS year, y.n AS safety_cases,
  p.n AS safety_cases_py, round((coalesce(y.n, 0) - p.n) / p.n, 6) AS safety_cases_yoy
FROM y FULL JOIN y p ON p.product_id = y.product_id AND p.year = y.year - 1
WHERE coalesce(y.year, p.year + 1) IN (SELECT year FROM y)""")
def safety_growth(t: Tables) -> DataFrame:
    return _rounded(measure(["safety_cases", "safety_cases_py", "safety_cases_yoy"], case_fact(t), ["product_id", "year"]))


@query("signal_measures", f"""{SIGNALS_SQL}
SELECT product_id, count(*) AS signals_evaluated, nullif(count(*) FILTER (is_reportable_signal), 0) AS active_signals,
  CASE WHEN count(*) = 1 THEN printf('%.2f to %.2f', min(prr_lower_95), max(prr_upper_95)) END AS prr_interval
FROM signals GROUP BY 1""")
def signal_measures(t: Tables) -> DataFrame:
    return measure(["signals_evaluated", "active_signals", "prr_interval"], signals(t), ["product_id"])


@query("recall_measures", f"""WITH {SEEDS_SQL}, {RECALLS_SQL}
SELECT product_id, count(*) AS product_recalls, count(*) FILTER (classification = 'Class I') AS class_1_recalls
FROM recalls GROUP BY 1""")
def recall_measures(t: Tables) -> DataFrame:
    return measure(["product_recalls", "class_1_recalls"], recall_mart(t), ["product_id"])


@query("run_measures", f"""WITH {RUNS_SQL}
SELECT source, count(*) AS ingestion_runs, nullif(count(*) FILTER (status = 'success'), 0) AS successful_runs,
  round(count(*) FILTER (status = 'success') / count(*), 6) AS run_success_rate,
  nullif(count(*) FILTER (overlapped_previous_run), 0) AS overlapping_runs,
  nullif(count(*) FILTER (triggered_by = 'github_actions'), 0) AS scheduled_runs,
  CAST(sum(rows_loaded) FILTER (NOT overlapped_previous_run) AS BIGINT) AS rows_ingested,
  CAST(sum(rows_loaded) FILTER (source = 'faers' AND NOT overlapped_previous_run) AS BIGINT) AS main_source_records,
  (SELECT strftime(max(finished_at), '%d %b %Y') FROM runs) AS data_as_of FROM runs GROUP BY 1""")
def run_measures(t: Tables) -> DataFrame:
    names = ["ingestion_runs", "successful_runs", "run_success_rate", "overlapping_runs", "scheduled_runs",
             "rows_ingested", "main_source_records", "data_as_of"]
    return _rounded(measure(names, t.layer("runs", lambda: runs(t)), ["source"]))


def check_results(t: Tables) -> DataFrame:
    """Lines as logged results: the order is the invocation, the flag the outcome."""
    logged = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("invocation_id"), "l_linestatus",
        F.when(F.col("l_linenumber") <= 4, "test").otherwise("model").alias("resource_type"),
        F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass").alias("status"),
        F.floor("l_extendedprice").alias("bytes_processed"),
        (F.floor("l_extendedprice") * 100_000_000).alias("bytes_billed"),
        F.col("l_shipdate").alias("run_started_at"))
    return run_results(logged).withColumn("estimated_cost_usd", F.col("estimated_cost_usd").cast("decimal(18,4)"))


@query("test_measures", """SELECT l_linestatus, count(DISTINCT l_orderkey) AS invocations,
  count(*) FILTER (l_linenumber <= 4) AS tests_run,
  count(*) FILTER (l_linenumber <= 4 AND l_returnflag != 'R') AS tests_passed,
  round(count(*) FILTER (l_linenumber <= 4 AND l_returnflag != 'R') / count(*) FILTER (l_linenumber <= 4), 6) AS test_pass_rate,
  round(CAST(sum(CAST(round(CAST(CAST(floor(l_extendedprice) AS BIGINT) * 100000000 AS DOUBLE) / pow(1024, 4) * 6.25, 4)
    AS DECIMAL(18, 4))) AS DOUBLE), 6) AS cost_estimate,
  round(CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS DOUBLE) / 1000000000, 6) AS gb_processed
FROM lineitem GROUP BY 1""")
def test_measures(t: Tables) -> DataFrame:
    names = ["invocations", "tests_run", "tests_passed", "test_pass_rate", "cost_estimate", "gb_processed"]
    return _rounded(measure(names, check_results(t), ["l_linestatus"]))


@query("mart_checks", f"""{CASES_SQL}, results AS (
  SELECT 'latest_cases' AS table_name, 'unique:caseid' AS test_name, count(*) - count(DISTINCT caseid) AS failures FROM latest
  UNION ALL SELECT 'latest_cases', 'not_null:caseid', count(*) FILTER (caseid IS NULL) FROM latest
  UNION ALL SELECT 'latest_cases', 'unique:primaryid', count(*) - count(DISTINCT primaryid) FROM latest
  UNION ALL SELECT 'latest_cases', 'not_null:primaryid', count(*) FILTER (primaryid IS NULL) FROM latest
  UNION ALL SELECT 'safety_cases', 'unique:safety_case_key', count(*) - count(DISTINCT safety_case_key) FROM cases
  UNION ALL SELECT 'safety_cases', 'not_null:safety_case_key', count(*) FILTER (safety_case_key IS NULL) FROM cases
  UNION ALL SELECT 'safety_cases', 'not_null:product_id', count(*) FILTER (product_id IS NULL) FROM cases
  UNION ALL SELECT 'safety_cases', 'relationships:product_id', count(*) FROM cases
    WHERE product_id NOT IN (SELECT product_id FROM products WHERE approval_year > 2000))
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM results""")
def mart_checks(t: Tables) -> DataFrame:
    """The standard tests of two marts, against a product list that lacks the older products."""
    known = products(t).where("approval_year > 2000")
    return check_tables({"latest_cases": latest_cases(reports_of(t)), "safety_cases": case_fact(t)}, known)


# --- report queries --------------------------------------------------------------------------

@query("report_top_brands", f"""{SPENDING_SQL}
SELECT brand_name, round(u, 6) AS spend_usd, round((u - coalesce(p, 0)) / p, 6) AS spend_usd_yoy FROM (
  SELECT *, rank() OVER (ORDER BY u DESC) AS r FROM (
    SELECT brand_name, sum(spending_usd) FILTER (year = 2000) AS u, sum(spending_usd) FILTER (year = 1999) AS p
    FROM spend GROUP BY 1)) WHERE r <= 5""")
def report_top_brands(t: Tables) -> DataFrame:
    return _rounded(reports.top_brands(spend_fact(t), YEARS, n=5))


@query("report_area_share", f"""{SPENDING_SQL}, top AS (SELECT brand_name FROM (
  SELECT brand_name, rank() OVER (ORDER BY sum(spending_usd) DESC) AS r FROM spend WHERE year = 2000 GROUP BY 1) WHERE r <= 5)
SELECT therapeutic_area, round(sum(spending_usd) FILTER (year = 2000), 6) AS spend_usd,
  round(sum(spending_usd) FILTER (year = 2000) / sum(spending_usd) FILTER (year = 1999) - 1, 6) AS spend_usd_yoy,
  round(sum(spending_usd) FILTER (year = 2000) / (SELECT sum(spending_usd) FROM spend WHERE year = 2000), 6) AS spend_share
FROM spend WHERE brand_name IN (SELECT brand_name FROM top) GROUP BY 1""")
def report_area_share(t: Tables) -> DataFrame:
    return _rounded(reports.area_share(spend_fact(t), YEARS, n=5))


@query("report_spend_by_segment", f"""{SPENDING_SQL}, y AS (
  SELECT year, portfolio_segment, sum(spending_usd) AS u FROM spend GROUP BY 1, 2)
SELECT y.year, y.portfolio_segment, round(y.u, 6) AS spend_usd, round(y.u / b.u * 100, 6) AS spend_index
FROM y LEFT JOIN y b ON b.portfolio_segment = y.portfolio_segment AND b.year = {BASE_YEAR} WHERE y.year NOT IN (1995, 2001)""")
def report_spend_by_segment(t: Tables) -> DataFrame:
    return _rounded(reports.spend_by_segment(spend_fact(t), [None, 1995, 2001], measures=MEASURES))


@query("report_serious_per_quarter", f"""{CASES_SQL}
SELECT CAST(year(fda_date) AS VARCHAR) || 'Q' || CAST(quarter(fda_date) AS VARCHAR) AS year_quarter,
  nullif(count(DISTINCT primaryid) FILTER (is_serious), 0) AS serious_cases,
  count(DISTINCT primaryid) - count(DISTINCT primaryid) FILTER (is_serious) AS non_serious_cases
FROM cases WHERE year(fda_date) IN (1999, 2000, 2001) GROUP BY 1""")
def report_serious_per_quarter(t: Tables) -> DataFrame:
    return reports.serious_per_quarter(case_fact(t), [1999, 2000, 2001])


@query("report_outcome_totals", f"""{CASES_SQL}
SELECT 'any_serious_outcome' AS outcome, count(DISTINCT primaryid) AS cases FROM cases WHERE is_serious
UNION ALL SELECT 'hospitalisation_cases', count(DISTINCT primaryid) FROM cases WHERE is_hospitalisation
UNION ALL SELECT 'life_threatening_cases', count(DISTINCT primaryid) FROM cases WHERE is_life_threatening
UNION ALL SELECT 'fatal_cases', count(DISTINCT primaryid) FROM cases WHERE is_death""")
def report_outcome_totals(t: Tables) -> DataFrame:
    return reports.outcome_totals(case_fact(t))


@query("report_age_and_sex", f"""{CASES_SQL}
SELECT age_group, sex, count(DISTINCT primaryid) AS safety_cases FROM cases WHERE sex IN ('F', 'M') GROUP BY 1, 2""")
def report_age_and_sex(t: Tables) -> DataFrame:
    return reports.cases_by_age_and_sex(case_fact(t))


@query("report_countries", f"""{CASES_SQL}
SELECT reporter_country, n AS safety_cases FROM (SELECT *, rank() OVER (ORDER BY n DESC) AS r FROM (
  SELECT reporter_country, count(DISTINCT primaryid) AS n FROM cases WHERE reporter_country IS NOT NULL GROUP BY 1))
WHERE r <= 8""")
def report_countries(t: Tables) -> DataFrame:
    return reports.reporter_countries(case_fact(t))


@query("report_signals", f"""{SIGNALS_SQL}
SELECT brand_name, reaction_pt, CAST(sum(cases_product_reaction) AS BIGINT) AS cases, round(sum(prr), 6) AS prr,
  CASE WHEN count(*) = 1 THEN printf('%.2f to %.2f', min(prr_lower_95), max(prr_upper_95)) END AS prr_interval
FROM signals JOIN products USING (product_id) WHERE is_reportable_signal GROUP BY 1, 2""")
def report_signals(t: Tables) -> DataFrame:
    named = star(signals(t), {"product": products(t)}, [("product_id", "product", "product_id", True)])
    return _rounded(reports.reportable_signals(named))


@query("report_active_by_phase", f"""{TRIALS_SQL}
SELECT phase_group, phase_sort, nullif(count(*) FILTER (is_owner_led AND status_group = 'Active'), 0) AS active_trials
FROM trials WHERE phase_group != 'Not applicable' GROUP BY 1, 2""")
def report_active_by_phase(t: Tables) -> DataFrame:
    return reports.active_by_phase(marts(t))


_PHASES = ["Phase 1", "Phase 1/2", "Phase 2", "Phase 2/3", "Phase 3", "Phase 4"]
_PHASE_CELLS = ", ".join(f"max(v) FILTER (s = '{p}') AS \"{p}\"" for p in [*_PHASES, "Total"])


@query("report_area_by_phase", f"""{TRIALS_SQL}
SELECT therapeutic_area, {_PHASE_CELLS} FROM (
  SELECT coalesce(therapeutic_area, 'Total') AS therapeutic_area, coalesce(phase_group, 'Total') AS s, count(*) AS v
  FROM trials WHERE is_owner_led AND status_group = 'Active' AND phase_group != 'Not applicable'
  GROUP BY CUBE (trials.therapeutic_area, phase_group)) GROUP BY 1""")
def report_area_by_phase(t: Tables) -> DataFrame:
    return reports.area_by_phase(marts(t), _PHASES)


@query("report_starts", f"""{TRIALS_SQL}
SELECT start_year, status_group, nullif(count(*) FILTER (is_owner_led), 0) AS owner_led_trials FROM trials
WHERE start_year IN (1997, 1998, 1999, 2000) GROUP BY 1, 2""")
def report_starts(t: Tables) -> DataFrame:
    return reports.starts_by_status(marts(t), [1997, 1998, 1999, 2000])


@query("report_readouts", f"""{TRIALS_SQL}
SELECT primary_completion_date, nct_id, brief_title, primary_product_brand, phase_group, enrollment_count FROM trials
WHERE readout_next_12_months AND is_owner_led AND phase_group != 'Not applicable'""")
def report_readouts(t: Tables) -> DataFrame:
    return reports.upcoming_readouts(marts(t))


@query("report_runs", f"""WITH {RUNS_SQL}
SELECT source, status, count(*) AS ingestion_runs,
  CAST(sum(rows_loaded) FILTER (NOT overlapped_previous_run) AS BIGINT) AS rows_ingested,
  nullif(count(*) FILTER (overlapped_previous_run), 0) AS overlapping_runs FROM runs GROUP BY 1, 2""")
def report_runs(t: Tables) -> DataFrame:
    return reports.runs_by_source(runs(t))
