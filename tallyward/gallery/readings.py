"""The retail tables read as reports, drugs, reactions, spending, studies, recalls and runs.

An order is a report, its customer the case, a line a drug with brand and ingredient, the
part name the reaction, the return flag the outcome. Each reading has the same text in SQL
for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import label
from tallyward.gallery import Tables
from tallyward.plans.observability import ingestion_runs
from tallyward.plans.staging import stage_codes, stage_drugs, stage_recalls, stage_reports, stage_studies, stage_terms
from tallyward.sources.documents import flatten_recalls, flatten_studies

OWNER = "URGENT|HIGH"

ALIAS_ROWS = """
    ('BRAND#1', 'P01', 'brand', false), ('BRAND#3', 'P02', 'brand', true),
    ('BRAND#5', 'P03', 'brand', false), ('BRAND#7', 'P04', 'brand', true),
    ('BRAND#9', 'P05', 'brand', false), ('BRAND#11', 'P06', 'brand', false),
    ('BRAND#13', 'P07', 'brand', true), ('BRAND#15', 'P08', 'brand', false),
    ('BRAND#17', 'P09', 'brand', false), ('BRAND#19', 'P10', 'brand', true),
    ('BRAND#21', 'P11', 'brand', false), ('BRAND#23', 'P12', 'brand', false),
    ('PROMO', 'P13', 'molecule', true), ('LARGE', 'P14', 'molecule', false),
    ('SMALL', 'P01', 'molecule', true)
"""
PRODUCT_ROWS = """
    ('P01', 'Brand#1', 'Oncology', 2017, NULL), ('P02', 'Brand#3', 'Neuroscience', 2010, 2019),
    ('P03', 'Brand#5', 'Immunology', 2003, NULL), ('P04', 'Brand#7', 'Ophthalmology', 2018, 2023),
    ('P05', 'Brand#9', 'Haematology', 2016, NULL), ('P06', 'Brand#11', 'Oncology', 2015, NULL),
    ('P07', 'Brand#13', 'Oncology', 1998, 2018), ('P08', 'Brand#15', 'Respiratory', 2014, NULL),
    ('P09', 'Brand#17', 'Immunology', 2022, NULL), ('P10', 'Brand#19', 'Neuroscience', NULL, NULL),
    ('P11', 'Brand#21', 'Oncology', 2019, NULL), ('P12', 'Brand#23', 'Rare Diseases', 2001, 2012),
    ('P13', 'Promo', 'Cardiovascular', 2012, NULL), ('P14', 'Large', 'Infectious Diseases', 2021, NULL)
"""
OCCUPATION_ROWS = """
    ('1', 'Physician', true), ('2', 'Pharmacist', true), ('3', 'Lawyer', false), ('4', 'Consumer', false)
"""
ALIAS_COLUMNS = "alias, product_id, alias_type, requires_owner"
PRODUCT_COLUMNS = "product_id, brand_name, therapeutic_area, approval_year, generic_entry_year"
OCCUPATION_COLUMNS = "occp_cod, reporter_type, is_health_professional"


def values(t: Tables, rows: str, columns: str) -> DataFrame:
    """A short literal table; its exact size is known to the join planner."""
    return t.spark.sql(f"SELECT * FROM VALUES {rows} AS v({columns})")


def aliases(t: Tables) -> DataFrame:
    return values(t, ALIAS_ROWS, ALIAS_COLUMNS)


def products(t: Tables) -> DataFrame:
    return values(t, PRODUCT_ROWS, PRODUCT_COLUMNS)


def occupations(t: Tables) -> DataFrame:
    return values(t, OCCUPATION_ROWS, OCCUPATION_COLUMNS)


SEEDS_SQL = f"""
aliases AS (SELECT * FROM (VALUES {ALIAS_ROWS}) AS v({ALIAS_COLUMNS})),
products AS (SELECT * FROM (VALUES {PRODUCT_ROWS}) AS v({PRODUCT_COLUMNS})),
occupations AS (SELECT * FROM (VALUES {OCCUPATION_ROWS}) AS v({OCCUPATION_COLUMNS}))
"""


# --- reports ---------------------------------------------------------------------------------

def raw_reports(t: Tables, profile: bool = False) -> DataFrame:
    """Orders as all-text report versions; ``profile`` adds the customer's sex and country."""
    status, priority, date = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    orders = t.orders
    if profile:
        people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("reporter_country"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "F")
            .when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), "M").otherwise("").alias("sex"))
        orders = orders.join(people, "o_custkey", "left")
    else:
        orders = orders.withColumns({"reporter_country": F.lit(""), "sex": F.lit("")})
    return orders.select(
        F.col("o_orderkey").cast("string").alias("primaryid"),
        F.col("o_custkey").cast("string").alias("caseid"),
        (F.year(date) - 1994).cast("string").alias("caseversion"),
        F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string")).alias("quarter"),
        F.when(priority == "5-LOW", F.date_format(date, "yyyyMM"))
        .when((status == "P") & (priority == "4-NOT SPECIFIED"), "unknown")
        .otherwise(F.date_format(date, "yyyyMMdd")).alias("fda_dt"),
        F.date_format(date, "yyyy").alias("init_fda_dt"),
        F.when(status == "F", F.date_format(date, "yyyyMMdd"))
        .otherwise(F.concat(F.date_format(date, "yyyyMM"), F.lit("99"))).alias("event_dt"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "EXP").when(priority == "3-MEDIUM", "PER")
        .when(priority == "4-NOT SPECIFIED", "DIR").otherwise("30DAY").alias("rept_cod"),
        F.concat(F.lit(" \t"), F.lower(priority), F.lit(" ")).alias("mfr_sndr"),
        F.substring(priority, 1, 1).alias("occp_cod"), "reporter_country", F.lit("").alias("occr_country"), "sex",
        F.floor(F.col("o_totalprice") / 4000).cast("string").alias("age"),
        F.when(status == "F", "YR").when(status == "O", "MON").otherwise("DEC").alias("age_cod"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("wt"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "KG").when(priority == "3-MEDIUM", "LBS")
        .when(priority == "4-NOT SPECIFIED", "GMS").otherwise("").alias("wt_cod"))


def reports(t: Tables, profile: bool = False) -> DataFrame:
    return stage_reports(raw_reports(t, profile), OWNER)


def _date_sql(col: str) -> str:
    return f"""CAST(CASE length({col}) WHEN 8 THEN try_strptime({col}, '%Y%m%d')
        WHEN 6 THEN try_strptime({col} || '01', '%Y%m%d')
        WHEN 4 THEN try_strptime({col} || '0101', '%Y%m%d') END AS DATE)"""


REPORTS_SQL = f"""
raw_reports AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS primaryid, CAST(o_custkey AS VARCHAR) AS caseid,
    year(o_orderdate) - 1994 AS caseversion,
    CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
    CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y%m')
         WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
         ELSE strftime(o_orderdate, '%Y%m%d') END AS fda_dt,
    strftime(o_orderdate, '%Y') AS init_fda_dt,
    CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d')
         ELSE strftime(o_orderdate, '%Y%m') || '99' END AS event_dt,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'EXP' WHEN o_orderpriority = '3-MEDIUM' THEN 'PER'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'DIR' ELSE '30DAY' END AS report_type,
    o_orderpriority AS sender, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_owner_sender,
    left(o_orderpriority, 1) AS occp_cod, n_name AS reporter_country,
    CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F'
         WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'M' END AS sex,
    floor(o_totalprice / 4000) AS age, floor(o_totalprice / 1000) AS wt, o_orderstatus, o_orderpriority
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey),
reports AS (
  SELECT primaryid, caseid, CAST(caseversion AS BIGINT) AS caseversion, quarter,
    {_date_sql('fda_dt')} AS fda_date, {_date_sql('init_fda_dt')} AS init_fda_date,
    {_date_sql('event_dt')} AS event_date, report_type, sender, is_owner_sender, occp_cod, reporter_country, sex,
    CASE o_orderstatus WHEN 'F' THEN age WHEN 'O' THEN age / 12 ELSE age * 10 END AS age_years,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN wt WHEN o_orderpriority = '3-MEDIUM' THEN wt * 0.453592
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN wt / 1000 END AS weight_kg
  FROM raw_reports)
"""


# --- children of reports ---------------------------------------------------------------------

def raw_drugs(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(part, "l_partkey").select(
        F.col("l_orderkey").cast("string").alias("primaryid"), F.lit(None).cast("string").alias("caseid"),
        F.col("l_linenumber").cast("string").alias("drug_seq"),
        F.when(F.col("l_linenumber") <= 2, "PS").otherwise("SS").alias("role_cod"),
        F.concat(F.lit("\t "), F.lower("p_brand"), F.lit(".. ")).alias("drugname"),
        F.concat(F.lower("p_type"), F.lit(".")).alias("prod_ai"),
        F.lit("ORAL").alias("route"), F.lit(None).cast("string").alias("quarter"))


def drugs(t: Tables) -> DataFrame:
    return stage_drugs(raw_drugs(t))


def reactions(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("pt"))
    rows = t.lineitem.select("l_orderkey", "l_partkey").join(part, "l_partkey").select(
        F.col("l_orderkey").cast("string").alias("primaryid"), F.lit(None).cast("string").alias("caseid"),
        "pt", F.lit(None).cast("string").alias("quarter"))
    return stage_terms(rows, "pt", "reaction_pt")


def indications(t: Tables) -> DataFrame:
    """The noun of the part name; parts of size 1 to 4 give a blank term."""
    part = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.when(F.col("p_size") < 5, "  ").otherwise(F.get(F.split("p_name", " "), F.lit(1))).alias("indi_pt"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(part, "l_partkey").select(
        F.col("l_orderkey").cast("string").alias("primaryid"), F.lit(None).cast("string").alias("caseid"),
        F.col("l_linenumber").cast("string").alias("indi_drug_seq"), "indi_pt",
        F.lit(None).cast("string").alias("quarter"))
    return stage_terms(rows, "indi_pt", "indication_pt", "indi_drug_seq")


def outcomes(t: Tables) -> DataFrame:
    """Return flags as outcome codes; line 7 has none."""
    rows = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("primaryid"), F.lit(None).cast("string").alias("caseid"),
        F.when(F.col("l_linenumber") < 7, F.concat(F.lit(" "), F.lower("l_returnflag"))).alias("outc_cod"),
        F.lit(None).cast("string").alias("quarter"))
    return stage_codes(rows, "outc_cod")


_TITLE = "upper(left({0}, 1)) || substr({0}, 2)"
CHILDREN_SQL = f"""
drugs AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS primaryid, CAST(l_linenumber AS BIGINT) AS drug_seq,
    CASE WHEN l_linenumber <= 2 THEN 'PS' ELSE 'SS' END AS role_cod,
    upper(p_brand) AS drugname_key, upper(p_type) AS prod_ai_key
  FROM lineitem JOIN part ON p_partkey = l_partkey),
reactions AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS primaryid,
    {_TITLE.format("split_part(p_name, ' ', 1)")} || ' ' || {_TITLE.format("split_part(p_name, ' ', 2)")} AS reaction_pt
  FROM lineitem JOIN part ON p_partkey = l_partkey),
indications AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS primaryid, CAST(l_linenumber AS BIGINT) AS drug_seq,
    {_TITLE.format("split_part(p_name, ' ', 2)")} AS indication_pt
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size >= 5),
outcomes AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS primaryid,
    CASE WHEN l_linenumber < 7 THEN l_returnflag END AS outc_cod FROM lineitem)
"""

LATEST_SQL = """
latest AS (
  SELECT primaryid, caseid, caseversion, quarter, fda_date, is_owner_sender FROM (
    SELECT *, row_number() OVER (PARTITION BY caseid
      ORDER BY caseversion DESC NULLS LAST, fda_date DESC, primaryid DESC) AS rn
    FROM reports WHERE fda_date IS NOT NULL) WHERE rn = 1),
attributed AS (
  SELECT primaryid, product_id, drug_seq, drugname_key, prod_ai_key, match_method, is_owner_sender FROM (
    SELECT d.primaryid, d.drug_seq, d.drugname_key, d.prod_ai_key, l.is_owner_sender,
      coalesce(n.product_id, i.product_id) AS product_id,
      CASE WHEN n.product_id IS NOT NULL THEN 'drug name' ELSE 'active ingredient' END AS match_method,
      coalesce(n.requires_owner, i.requires_owner) AS requires_owner,
      row_number() OVER (PARTITION BY d.primaryid, coalesce(n.product_id, i.product_id)
        ORDER BY d.drug_seq, d.drugname_key, d.prod_ai_key) AS rn
    FROM drugs d JOIN latest l USING (primaryid)
    LEFT JOIN aliases n ON n.alias = d.drugname_key LEFT JOIN aliases i ON i.alias = d.prod_ai_key
    WHERE d.role_cod = 'PS' AND coalesce(n.product_id, i.product_id) IS NOT NULL
      AND (NOT coalesce(n.requires_owner, i.requires_owner) OR l.is_owner_sender)) WHERE rn = 1)
"""
SAFETY_SQL = f"WITH {SEEDS_SQL}, {REPORTS_SQL}, {CHILDREN_SQL}, {LATEST_SQL}"


# --- studies and recalls ---------------------------------------------------------------------

CONDITIONS = {
    "plate": "Lung Carcinoma", "rod": "Anemia", "gear": "Multiple Sclerosis", "gizmo": "Macular Degeneration",
    "anvil": "HIV Infection", "widget": "Asthma", "ring": "Stroke", "bolt": "Back Pain",
}
REASONS = {
    "STANDARD": "Lack of Sterility Assurance", "ECONOMY": "Presence of Particulate Matter",
    "MEDIUM": "Defective Delivery System", "PROMO": "Failed Stability Testing", "LARGE": "Label Mix-up",
    "SMALL": "Missing Tablets",
}
SPONSOR = "BUILDING|MACHINERY"
AS_OF = "2000-06-30"


def study_documents(t: Tables) -> DataFrame:
    """Each order as a nested study document; its lists hold distinct short names."""
    part = t.part.select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_brand", "p_type").alias("drug"),
        label(F.get(F.split("p_name", " "), F.lit(1)), CONDITIONS).alias("condition"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate").join(part, "l_partkey")
    # Sorted by order the lists grow one after the other; a sort costs less than a table of half lists that is sent on.
    lines = lines.repartition("l_orderkey").sortWithinPartitions("l_orderkey")
    arms = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_set("drug")).alias("drugs"),
        F.sort_array(F.collect_set("condition")).alias("conditions"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("enrollment"),
        F.max("l_shipdate").alias("last_ship"))
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    date, price = F.col("o_orderdate"), F.floor(F.col("o_totalprice") / 60000)
    codes = [["EARLY_PHASE1"], ["PHASE1"], ["PHASE1", "PHASE2"], ["PHASE2"], ["PHASE2", "PHASE3"], ["PHASE3"],
             ["PHASE4"]]
    phases = F.array(F.lit("NA"))
    for i, code in enumerate(codes):
        phases = F.when(price == i, F.array(*[F.lit(c) for c in code])).otherwise(phases)
    place = F.struct(F.col("n_name").alias("country"))
    nowhere = F.struct(F.lit(None).cast("string").alias("country"))

    def dated(value, name: str):
        return F.struct(value.alias("date")).alias(name)

    return (
        t.orders.join(people, "o_custkey", "left").join(arms, "o_orderkey", "left").select(
            F.struct(
                F.struct(
                    F.concat(F.lit("NCT"), F.col("o_orderkey").cast("string")).alias("nctId"),
                    F.concat(F.lit("Study "), priority).alias("briefTitle"),
                    F.lit(None).cast("string").alias("acronym")).alias("identificationModule"),
                F.struct(
                    F.when(status == "F", "COMPLETED")
                    .when((status == "P") & (priority < "3"), "TERMINATED").when(status == "P", "UNKNOWN")
                    .when(priority == "1-URGENT", "RECRUITING").when(priority == "2-HIGH", "NOT_YET_RECRUITING")
                    .otherwise("ACTIVE_NOT_RECRUITING").alias("overallStatus"),
                    F.lit(None).cast("string").alias("whyStopped"),
                    dated(F.when(priority == "5-LOW", F.date_format(date, "yyyy-MM"))
                          .otherwise(F.date_format(date, "yyyy-MM-dd")), "startDateStruct"),
                    dated(F.when(priority != "4-NOT SPECIFIED", F.date_format("last_ship", "yyyy-MM-dd")),
                          "primaryCompletionDateStruct"),
                    dated(F.date_format("last_ship", "yyyy"), "completionDateStruct"),
                    dated(F.date_format(date, "yyyy-MM-dd"), "studyFirstPostDateStruct"),
                    dated(F.lit("2001-13-01"), "lastUpdatePostDateStruct")).alias("statusModule"),
                F.struct(
                    F.struct(F.col("c_mktsegment").alias("name"), F.lit("INDUSTRY").alias("class")).alias("leadSponsor"),
                    F.array(F.struct(F.lit("").alias("name")), F.struct(F.col("c_mktsegment").alias("name")),
                            F.struct(F.col("c_mktsegment").alias("name"))).alias("collaborators")
                ).alias("sponsorCollaboratorsModule"),
                F.struct(
                    F.lit("INTERVENTIONAL").alias("studyType"), phases.alias("phases"),
                    F.struct(F.col("enrollment").cast("string").alias("count"), F.lit("ACTUAL").alias("type"))
                    .alias("enrollmentInfo")).alias("designModule"),
                F.struct("conditions", F.lit(None).cast("array<string>").alias("keywords")).alias("conditionsModule"),
                F.struct(F.transform("drugs", lambda d: F.struct(F.lit("DRUG").alias("type"), d.alias("name")))
                         .alias("interventions")).alias("armsInterventionsModule"),
                F.struct(F.when(priority != "5-LOW", F.array(place, place, nowhere)).alias("locations"))
                .alias("contactsLocationsModule")).alias("protocolSection"),
            F.lit(None).cast("struct<conditionBrowseModule:struct<meshes:array<struct<term:string>>>>")
            .alias("derivedSection"),
            (status == "F").alias("hasResults")))


def studies(t: Tables) -> DataFrame:
    return stage_studies(flatten_studies(study_documents(t), "2024-01-31"), SPONSOR)


_CONDITION_SQL = "CASE split_part(p_name, ' ', 2) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in CONDITIONS.items()) + " END"
STUDIES_SQL = f"""
arms AS (
  SELECT l_orderkey, string_agg(DISTINCT p_brand || ' ' || p_type, '|' ORDER BY p_brand || ' ' || p_type) AS interventions,
    string_agg(DISTINCT {_CONDITION_SQL}, '|' ORDER BY {_CONDITION_SQL}) AS conditions,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS enrollment_count, max(l_shipdate) AS last_ship
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
studies AS (
  SELECT 'NCT' || CAST(o_orderkey AS VARCHAR) AS nct_id, 'Study ' || o_orderpriority AS brief_title,
    CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'P' AND o_orderpriority < '3' THEN 'TERMINATED'
      WHEN o_orderstatus = 'P' THEN 'UNKNOWN' WHEN o_orderpriority = '1-URGENT' THEN 'RECRUITING'
      WHEN o_orderpriority = '2-HIGH' THEN 'NOT_YET_RECRUITING' ELSE 'ACTIVE_NOT_RECRUITING' END AS overall_status,
    CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'P' AND o_orderpriority < '3' THEN 'Stopped'
      WHEN o_orderstatus = 'P' THEN 'Other' ELSE 'Active' END AS status_group,
    CASE WHEN o_orderpriority = '5-LOW' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
      ELSE CAST(o_orderdate AS DATE) END AS start_date,
    CASE WHEN o_orderpriority != '4-NOT SPECIFIED' THEN CAST(last_ship AS DATE) END AS primary_completion_date,
    CAST(date_trunc('year', last_ship) AS DATE) AS completion_date, CAST(o_orderdate AS DATE) AS first_post_date,
    c_mktsegment AS lead_sponsor, c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_owner_led,
    CASE least(floor(o_totalprice / 60000), 7) WHEN 0 THEN 'EARLY_PHASE1' WHEN 1 THEN 'PHASE1' WHEN 2 THEN 'PHASE1|PHASE2'
      WHEN 3 THEN 'PHASE2' WHEN 4 THEN 'PHASE2|PHASE3' WHEN 5 THEN 'PHASE3' WHEN 6 THEN 'PHASE4' ELSE 'NA' END AS phases,
    CASE least(floor(o_totalprice / 60000), 7) WHEN 0 THEN 'Phase 1' WHEN 1 THEN 'Phase 1' WHEN 2 THEN 'Phase 1/2'
      WHEN 3 THEN 'Phase 2' WHEN 4 THEN 'Phase 2/3' WHEN 5 THEN 'Phase 3' WHEN 6 THEN 'Phase 4'
      ELSE 'Not applicable' END AS phase_group,
    CAST(CASE least(floor(o_totalprice / 60000), 7) WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4
      WHEN 5 THEN 5 WHEN 6 THEN 6 ELSE 7 END AS BIGINT) AS phase_sort,
    enrollment_count, conditions, interventions,
    CASE WHEN o_orderpriority != '5-LOW' THEN n_name END AS countries,
    CAST(CASE WHEN o_orderpriority != '5-LOW' THEN 1 ELSE 0 END AS BIGINT) AS country_count,
    CAST(CASE WHEN o_orderpriority != '5-LOW' THEN 3 ELSE 0 END AS BIGINT) AS location_count,
    o_orderstatus = 'F' AS has_results
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN arms ON l_orderkey = o_orderkey),
study_products AS (
  SELECT nct_id, product_id, max(length(alias)) AS best_alias_length FROM studies JOIN aliases
    ON regexp_matches(upper(interventions), '(^|[^A-Z0-9])' || alias || '([^A-Z0-9]|$)') GROUP BY 1, 2),
trials AS (
  SELECT s.*, b.product_id AS primary_product_id, coalesce(p.brand_name, 'No marketed product') AS primary_product_brand,
    coalesce(b.product_count, 0) AS product_count, coalesce(p.therapeutic_area,
      CASE WHEN regexp_matches(conditions, 'Carcinoma') THEN 'Oncology' WHEN regexp_matches(conditions, 'Anemia') THEN 'Haematology'
        WHEN regexp_matches(conditions, 'Sclerosis') THEN 'Neuroscience' WHEN regexp_matches(conditions, 'Macular') THEN 'Ophthalmology'
        WHEN regexp_matches(conditions, 'HIV') THEN 'Infectious Diseases' WHEN regexp_matches(conditions, 'Asthma') THEN 'Immunology'
        WHEN regexp_matches(conditions, 'Stroke') THEN 'Cardiovascular' ELSE 'Other' END) AS therapeutic_area,
    CASE WHEN is_owner_led THEN 'Owner-led' ELSE 'Collaboration' END AS sponsor_role,
    year(start_date) AS start_year,
    date_diff('month', start_date, coalesce(primary_completion_date, completion_date)) AS planned_duration_months,
    status_group = 'Active' AND primary_completion_date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + INTERVAL 12 MONTH
      AS readout_next_12_months
  FROM studies s LEFT JOIN (
    SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY nct_id) AS product_count,
      row_number() OVER (PARTITION BY nct_id ORDER BY best_alias_length DESC, product_id) AS rn FROM study_products)
    WHERE rn = 1) b USING (nct_id) LEFT JOIN products p ON p.product_id = b.product_id)
"""


def recall_documents(t: Tables) -> DataFrame:
    """Each part as a recall document: brand lists for small sizes, text for the rest."""
    size = F.col("p_size")
    return t.part.select(
        F.concat(F.lit("D-"), F.col("p_partkey").cast("string")).alias("recall_number"),
        F.col("p_brand").alias("event_id"), F.when(size < 40, "Terminated").otherwise("Ongoing").alias("status"),
        F.when(size < 10, "Class I").when(size < 30, "Class II").otherwise("Class III").alias("classification"),
        F.lit("Drugs").alias("product_type"), F.col("p_type").alias("recalling_firm"),
        label("p_type", REASONS).alias("reason_for_recall"),
        F.concat(F.lit("Lot "), "p_name", F.lit(" "), "p_brand",
                 F.when(size < 35, "5 mg/").otherwise("mg/"), size.cast("string")).alias("product_description"),
        *[F.lit(None).cast("string").alias(c) for c in ("product_quantity", "distribution_pattern")],
        F.lit("Voluntary").alias("voluntary_mandated"), F.lit(None).cast("string").alias("initial_firm_notification"),
        F.concat(F.lit("20"), F.lpad(size.cast("string"), 2, "0"), F.lit("0131")).alias("recall_initiation_date"),
        F.concat(F.lit("20"), F.lpad(size.cast("string"), 2, "0"), F.lit("02")).alias("center_classification_date"),
        F.lit(None).cast("string").alias("report_date"),
        F.when(size < 40, F.lit("20241331")).alias("termination_date"),
        *[F.lit(None).cast("string").alias(c) for c in ("city", "state", "country")],
        F.when(size <= 35, F.struct(
            F.when(size <= 20, F.array(F.concat(F.lower("p_brand"), F.lit(".")), F.lit("X")))
            .otherwise(F.array().cast("array<string>")).alias("brand_name"),
            F.when(size <= 10, F.array(F.lit("a"), F.lit("a"))).alias("generic_name"))).alias("openfda"))


def recall_rows(t: Tables) -> DataFrame:
    return stage_recalls(flatten_recalls(recall_documents(t)))


RECALLS_SQL = """
recall_rows AS (
  SELECT 'D-' || CAST(p_partkey AS VARCHAR) AS recall_number,
    CASE WHEN p_size < 40 THEN 'Terminated' ELSE 'Ongoing' END AS status,
    CASE WHEN p_size < 10 THEN 'Class I' WHEN p_size < 30 THEN 'Class II' ELSE 'Class III' END AS classification,
    CASE p_type WHEN 'STANDARD' THEN 'Lack of Sterility Assurance' WHEN 'ECONOMY' THEN 'Presence of Particulate Matter'
      WHEN 'MEDIUM' THEN 'Defective Delivery System' WHEN 'PROMO' THEN 'Failed Stability Testing'
      WHEN 'LARGE' THEN 'Label Mix-up' ELSE 'Missing Tablets' END AS reason_for_recall,
    CASE p_type WHEN 'STANDARD' THEN 'Sterility assurance' WHEN 'ECONOMY' THEN 'Particulate / foreign matter'
      WHEN 'MEDIUM' THEN 'Device / delivery system' WHEN 'PROMO' THEN 'Quality specification'
      WHEN 'LARGE' THEN 'Labelling' ELSE 'Other' END AS reason_category,
    'Lot ' || p_name || ' ' || p_brand || CASE WHEN p_size < 35 THEN '5 mg/' ELSE 'mg/' END || CAST(p_size AS VARCHAR)
      AS product_description,
    'Voluntary' AS voluntary_mandated,
    make_date(2000 + p_size, 1, 31) AS recall_initiation_date, make_date(2000 + p_size, 2, 1) AS classification_date,
    CAST(NULL AS DATE) AS termination_date,
    CASE WHEN p_size <= 20 THEN upper(p_brand) END AS brand_key,
    CASE WHEN p_size <= 20 THEN lower(p_brand) || '.|X' END AS brand_names,
    CASE WHEN p_size <= 10 THEN 'a|a' END AS generic_names
  FROM part),
recalls AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT r.recall_number, coalesce(a.product_id, d.product_id) AS product_id, r.classification, r.status,
      r.reason_category, r.reason_for_recall, r.product_description, r.voluntary_mandated, r.recall_initiation_date,
      r.classification_date, r.termination_date, year(r.recall_initiation_date) AS recall_year,
      row_number() OVER (PARTITION BY r.recall_number ORDER BY length(d.alias) DESC NULLS LAST, d.product_id) AS rn
    FROM recall_rows r LEFT JOIN (SELECT * FROM aliases WHERE alias_type = 'brand') a ON a.alias = r.brand_key
    LEFT JOIN (SELECT * FROM aliases WHERE alias_type = 'brand') d ON a.product_id IS NULL
      AND regexp_matches(upper(r.product_description), '(^|[^A-Z])' || d.alias || '([^A-Z]|$)')) WHERE rn = 1)
"""


# --- runs ------------------------------------------------------------------------------------

def raw_runs(t: Tables) -> DataFrame:
    """Events as runs: the type is the source, ten seconds per value unit; some never finished."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.round(F.col("value") * 10_000_000).cast("bigint")
    return t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "purchase", "faers").otherwise(F.col("event_type")).alias("source"),
        F.when(F.col("value") < 5, "failed").otherwise("success").alias("status"),
        F.timestamp_micros(start).alias("started_at"),
        F.when(~F.col("value").between(20, 22), F.timestamp_micros(start + length)).alias("finished_at"),
        F.floor(F.col("value") * 10).cast("bigint").alias("rows_loaded"),
        F.when(F.col("value") < 12, "github_actions").otherwise("local").alias("triggered_by"))


def runs(t: Tables) -> DataFrame:
    return ingestion_runs(raw_runs(t)).withColumn("year", F.year("run_date").cast("bigint"))


RUNS_SQL = """
raw_runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id,
    CASE WHEN event_type = 'purchase' THEN 'faers' ELSE event_type END AS source,
    CASE WHEN value < 5 THEN 'failed' ELSE 'success' END AS status, ts AS started_at,
    CASE WHEN value NOT BETWEEN 20 AND 22 THEN ts + to_microseconds(CAST(round(value * 10000000) AS BIGINT)) END AS finished_at,
    CAST(floor(value * 10) AS BIGINT) AS rows_loaded,
    CASE WHEN value < 12 THEN 'github_actions' ELSE 'local' END AS triggered_by
  FROM events),
runs AS (
  SELECT r.*, CAST(r.started_at AS DATE) AS run_date, EXISTS (
    SELECT 1 FROM raw_runs o WHERE o.source = r.source AND o.run_id != r.run_id
      AND o.started_at < r.started_at AND o.finished_at > r.started_at) AS overlapped_previous_run
  FROM raw_runs r)
"""
