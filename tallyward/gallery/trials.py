"""Studies, recalls, term search and history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import classify, contains_at, matches
from tallyward.gallery import Tables, query
from tallyward.gallery.readings import (
    AS_OF,
    RECALLS_SQL,
    SEEDS_SQL,
    STUDIES_SQL,
    aliases,
    products,
    recall_rows,
    studies,
    values,
)
from tallyward.operators import history, terms
from tallyward.plans import trials
from tallyward.session import shared_folder
from tallyward.sources.lake import read_history, write_history

WORD_ROWS = """
    ('THE', 'W1'), ('AND', 'W2'), ('UND', 'W3'), ('OF THE', 'W4'), ('EN', 'W5'), ('ET', 'W6'), ('IT. THE', 'W7'),
    ('TO BE', 'W1'), ('LA', 'W8'), ('É', 'W9'), ('-', 'W10'), ('X-1', 'W11')
"""
TRIALS_SQL = f"WITH {SEEDS_SQL}, {STUDIES_SQL}"


def marts(t: Tables) -> DataFrame:
    """Studies feed the term search and the mart; both are written once."""
    staged = t.layer("studies", lambda: studies(t))
    return t.layer("clinical_trials", lambda: trials.clinical_trials(
        staged, trials.study_products(staged, aliases(t)), products(t), AS_OF))


@query("staged_studies", f"{TRIALS_SQL} SELECT * FROM studies")
def staged_studies(t: Tables) -> DataFrame:
    return studies(t).drop(
        "acronym", "why_stopped", "last_update_post_date", "lead_sponsor_class", "collaborators", "study_type",
        "enrollment_type", "keywords", "mesh_terms", "intervention_types", "snapshot_date")


@query("study_products", f"{TRIALS_SQL} SELECT * FROM study_products")
def study_products(t: Tables) -> DataFrame:
    return trials.study_products(studies(t), aliases(t))


@query("clinical_trials", f"""{TRIALS_SQL}
SELECT nct_id, primary_product_id, primary_product_brand, product_count, therapeutic_area, overall_status, status_group,
  phase_group, phase_sort, is_owner_led, sponsor_role, lead_sponsor, start_date, primary_completion_date,
  completion_date, start_year, planned_duration_months, readout_next_12_months, enrollment_count, country_count,
  location_count, has_results, conditions FROM trials""")
def clinical_trials(t: Tables) -> DataFrame:
    return marts(t).drop(
        "brief_title", "acronym", "why_stopped", "study_type", "last_update_post_date", "enrollment_type",
        "snapshot_date")


@query("area_members", f"""{TRIALS_SQL}
SELECT therapeutic_area, CAST(CASE therapeutic_area WHEN 'Oncology' THEN 1 WHEN 'Neuroscience' THEN 2
  WHEN 'Immunology' THEN 3 WHEN 'Ophthalmology' THEN 4 WHEN 'Haematology' THEN 5 WHEN 'Respiratory' THEN 6
  WHEN 'Infectious Diseases' THEN 7 WHEN 'Cardiovascular' THEN 8 ELSE 99 END AS BIGINT) AS sort_order
FROM (SELECT therapeutic_area FROM products UNION SELECT therapeutic_area FROM trials)""")
def area_members(t: Tables) -> DataFrame:
    return trials.area_dimension(products(t), marts(t))


@query("staged_recalls", f"WITH {RECALLS_SQL} SELECT * FROM recall_rows".replace("WITH \n", "WITH "))
def staged_recalls(t: Tables) -> DataFrame:
    return recall_rows(t).drop("event_id", "recalling_firm", "distribution_pattern")


@query("recalls", f"WITH {SEEDS_SQL}, {RECALLS_SQL} SELECT * FROM recalls")
def recalls(t: Tables) -> DataFrame:
    return trials.recalls(recall_rows(t), aliases(t).where("alias_type = 'brand'"))


# Upper case of the sharp s is SS; DuckDB maps it to one letter, so the oracle spells it out.
_TERM_SQL = f"""SELECT doc_id, product_id, max(length(alias)) AS best_alias_length
FROM documents JOIN (VALUES {WORD_ROWS}) AS w(alias, product_id)
  ON regexp_matches(upper(replace(text, 'ß', 'ss')), '(^|[^A-Z0-9])' || regexp_escape(alias) || '([^A-Z0-9]|$)') GROUP BY 1, 2"""


@query("term_join", _TERM_SQL)
def term_join(t: Tables) -> DataFrame:
    words = values(t, WORD_ROWS, "alias, product_id")
    return terms.match_terms(t.documents, "doc_id", "text", words)


@query("term_join_regex", _TERM_SQL)
def term_join_regex(t: Tables) -> DataFrame:
    words = [("THE", "W1"), ("AND", "W2"), ("UND", "W3"), ("OF THE", "W4"), ("EN", "W5"), ("ET", "W6"),
             ("IT. THE", "W7"), ("TO BE", "W1"), ("LA", "W8"), ("É", "W9"), ("-", "W10"), ("X-1", "W11")]
    return terms.match_terms_regex(t.documents, "doc_id", "text", words)


@query("pattern_rows", """SELECT lang, count(*) AS n_docs,
  count(*) FILTER (regexp_matches(text, '(^|[^a-z])' || lang || '([^a-z]|$)')) AS n_match FROM documents GROUP BY 1""")
def pattern_rows(t: Tables) -> DataFrame:
    pattern = F.concat(F.lit("(^|[^a-z])"), "lang", F.lit("([^a-z]|$)"))
    return t.documents.withColumn("hit", matches("text", pattern)).groupBy("lang").agg(
        F.count("*").alias("n_docs"), F.count_if("hit").alias("n_match"))


@query("classify_text", """SELECT category, count(*) AS n FROM (
  SELECT CASE WHEN regexp_matches(upper(p_name), 'RING|ROD') THEN 'round' WHEN regexp_matches(upper(p_name), 'RED|HOT')
    THEN 'warm' WHEN regexp_matches(upper(p_name), '^OLD') THEN 'old' ELSE 'Other' END AS category FROM part) GROUP BY 1""")
def classify_text(t: Tables) -> DataFrame:
    rules = [("RING|ROD", "round"), ("RED|HOT", "warm"), ("^OLD", "old")]
    return t.part.select(classify("p_name", rules).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query("term_positions", """SELECT p_brand, instr(p_name, 'i') AS at, count(*) AS n FROM part GROUP BY 1, 2""")
def term_positions(t: Tables) -> DataFrame:
    return t.part.withColumn("at", contains_at("p_name", F.lit("i"))).groupBy("p_brand", "at").agg(
        F.count("*").alias("n"))


def customer_snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two snapshots: nation 5 joins later, furniture buyers in debt leave, builders gain, names change."""
    base = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    joined = F.col("c_nationkey") != 5
    first = t.customer.where(joined).select(*base.columns)
    second = (
        base.where(~((F.col("c_mktsegment") == "FURNITURE") & (F.col("c_acctbal") < 0)))
        .withColumn("c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100)
                    .otherwise(F.col("c_acctbal")))
        .withColumn("c_name", F.upper("c_name")))
    return first, second


CHECKED = ["c_acctbal", "c_mktsegment"]


def customer_history(t: Tables) -> DataFrame:
    first, second = customer_snapshots(t)
    return history.scd2_merge(
        history.start_history(first, "2024-01-01"), second, "c_custkey", CHECKED, "2024-02-01")


HISTORY_SQL = """WITH s1 AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_nationkey != 5),
s2 AS (SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
  FROM customer WHERE NOT (c_mktsegment = 'FURNITURE' AND c_acctbal < 0)),
history AS (
  SELECT s1.*, DATE '2024-01-01' AS valid_from, CASE WHEN s2.c_custkey IS NOT NULL
    AND (s1.c_acctbal IS DISTINCT FROM s2.c_acctbal OR s1.c_mktsegment IS DISTINCT FROM s2.c_mktsegment)
    THEN DATE '2024-02-01' END AS valid_to FROM s1 LEFT JOIN s2 USING (c_custkey)
  UNION ALL
  SELECT s2.*, DATE '2024-02-01', CAST(NULL AS DATE) FROM s2 LEFT JOIN s1 USING (c_custkey)
  WHERE s1.c_custkey IS NULL OR s1.c_acctbal IS DISTINCT FROM s2.c_acctbal
    OR s1.c_mktsegment IS DISTINCT FROM s2.c_mktsegment)
"""


@query("scd2", f"{HISTORY_SQL} SELECT * FROM history")
def scd2(t: Tables) -> DataFrame:
    return customer_history(t)


@query("scd2_as_of", f"{HISTORY_SQL} SELECT * FROM history WHERE valid_from <= DATE '2024-01-15' "
       "AND (valid_to IS NULL OR valid_to > DATE '2024-01-15')")
def scd2_as_of(t: Tables) -> DataFrame:
    return history.as_of(customer_history(t), "2024-01-15")


@query("scd2_table", f"{HISTORY_SQL} SELECT * FROM history")
def scd2_table(t: Tables) -> DataFrame:
    """The same history kept as a table; the second snapshot is loaded twice."""
    path = shared_folder(t.spark, "customer-history")
    first, second = customer_snapshots(t)
    write_history(history.start_history(first, "2024-01-01"), path, "1")
    for _ in range(2):
        load_snapshot(t, path, second, "2024-02-01", "2")
    return read_history(t.spark, path)


def load_snapshot(t: Tables, path: str, snapshot: DataFrame, day: str, name: str) -> None:
    current = history.open_versions(read_history(t.spark, path))
    write_history(history.scd2_step(current, snapshot, "c_custkey", CHECKED, day), path, name)


@query("scd2_same_day", """WITH v AS (
  SELECT c_custkey, c_acctbal, 0 AS step, true AS there FROM customer
  UNION ALL SELECT c_custkey, c_acctbal + 1, 1, c_custkey % 3 = 0 FROM customer
  UNION ALL SELECT c_custkey, c_acctbal + 2, 2, c_custkey % 3 = 1 FROM customer)
SELECT c_custkey, c_acctbal, CASE WHEN step = 0 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS valid_from,
  CASE WHEN step = 0 AND c_custkey % 3 < 2 THEN DATE '2024-02-01' END AS valid_to FROM v WHERE there""")
def scd2_same_day(t: Tables) -> DataFrame:
    """Two different snapshots of one day, the first loaded again after the second's changes are known."""
    path = shared_folder(t.spark, "same-day-history")
    base = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")

    def raised(*rests: int) -> DataFrame:
        extra = F.lit(0)
        for step, rest in enumerate(rests, 1):
            extra = F.when(F.col("c_custkey") % 3 == rest, step).otherwise(extra)
        return base.withColumn("c_acctbal", F.col("c_acctbal") + extra)

    write_history(history.start_history(base, "2024-01-01"), path, "1")
    load_snapshot(t, path, raised(0), "2024-02-01", "2a")
    load_snapshot(t, path, raised(0, 1), "2024-02-01", "2b")
    load_snapshot(t, path, raised(0, 1), "2024-02-01", "2b")
    return read_history(t.spark, path).select("c_custkey", "c_acctbal", "valid_from", "valid_to")
