"""Nested study and recall documents, wide spending rows and exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.text import join_distinct
from tallyward.operators.ranking import stable_sort
from tallyward.operators.reshape import discover_suffixes, drop_null

# The part of the study document that is read.
STUDY_SCHEMA = """
    protocolSection STRUCT<
        identificationModule: STRUCT<nctId: STRING, briefTitle: STRING, acronym: STRING>,
        statusModule: STRUCT<
            overallStatus: STRING, whyStopped: STRING,
            startDateStruct: STRUCT<date: STRING>,
            primaryCompletionDateStruct: STRUCT<date: STRING>,
            completionDateStruct: STRUCT<date: STRING>,
            studyFirstPostDateStruct: STRUCT<date: STRING>,
            lastUpdatePostDateStruct: STRUCT<date: STRING>>,
        sponsorCollaboratorsModule: STRUCT<
            leadSponsor: STRUCT<name: STRING, class: STRING>,
            collaborators: ARRAY<STRUCT<name: STRING>>>,
        designModule: STRUCT<
            studyType: STRING, phases: ARRAY<STRING>,
            enrollmentInfo: STRUCT<count: STRING, type: STRING>>,
        conditionsModule: STRUCT<conditions: ARRAY<STRING>, keywords: ARRAY<STRING>>,
        armsInterventionsModule: STRUCT<interventions: ARRAY<STRUCT<type: STRING, name: STRING>>>,
        contactsLocationsModule: STRUCT<locations: ARRAY<STRUCT<country: STRING>>>>,
    derivedSection STRUCT<conditionBrowseModule: STRUCT<meshes: ARRAY<STRUCT<term: STRING>>>>,
    hasResults BOOLEAN
"""

# The recall fields that are kept as they are.
RECALL_FIELDS = [
    "recall_number", "event_id", "status", "classification", "product_type", "recalling_firm",
    "reason_for_recall", "product_description", "product_quantity", "distribution_pattern",
    "voluntary_mandated", "initial_firm_notification", "recall_initiation_date",
    "center_classification_date", "report_date", "termination_date", "city", "state", "country",
]
RECALL_SCHEMA = ", ".join(f"{f} STRING" for f in RECALL_FIELDS) + \
    ", openfda STRUCT<brand_name: ARRAY<STRING>, generic_name: ARRAY<STRING>>"


def read_documents(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """JSON lines (or one array per file) with an explicit schema; missing branches are null."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def flatten_studies(df: DataFrame, snapshot_date: str | None = None) -> DataFrame:
    """One flat row per study; lists are joined by ``|`` in first-seen order."""
    p = "protocolSection"
    status, design = f"{p}.statusModule", f"{p}.designModule"
    sponsor, arms = f"{p}.sponsorCollaboratorsModule", f"{p}.armsInterventionsModule.interventions"
    locations = f"{p}.contactsLocationsModule.locations"

    def date(name: str):
        return F.col(f"{status}.{name}.date")

    out = df.select(
        F.col(f"{p}.identificationModule.nctId").alias("nct_id"),
        F.col(f"{p}.identificationModule.briefTitle").alias("brief_title"),
        F.col(f"{p}.identificationModule.acronym").alias("acronym"),
        F.col(f"{status}.overallStatus").alias("overall_status"),
        F.col(f"{status}.whyStopped").alias("why_stopped"),
        date("startDateStruct").alias("start_date"),
        date("primaryCompletionDateStruct").alias("primary_completion_date"),
        date("completionDateStruct").alias("completion_date"),
        date("studyFirstPostDateStruct").alias("first_post_date"),
        date("lastUpdatePostDateStruct").alias("last_update_post_date"),
        F.col(f"{sponsor}.leadSponsor.name").alias("lead_sponsor"),
        F.col(f"{sponsor}.leadSponsor.class").alias("lead_sponsor_class"),
        join_distinct(f"{sponsor}.collaborators.name").alias("collaborators"),
        F.col(f"{design}.studyType").alias("study_type"),
        join_distinct(f"{design}.phases").alias("phases"),
        F.col(f"{design}.enrollmentInfo.count").try_cast("double").cast("bigint").alias("enrollment_count"),
        F.col(f"{design}.enrollmentInfo.type").alias("enrollment_type"),
        join_distinct(f"{p}.conditionsModule.conditions").alias("conditions"),
        join_distinct(f"{p}.conditionsModule.keywords").alias("keywords"),
        join_distinct("derivedSection.conditionBrowseModule.meshes.term").alias("mesh_terms"),
        join_distinct(f"{arms}.type").alias("intervention_types"),
        join_distinct(f"{arms}.name").alias("interventions"),
        join_distinct(f"{locations}.country").alias("countries"),
        F.coalesce(F.size(locations), F.lit(0)).cast("bigint").alias("location_count"),
        F.col("hasResults").alias("has_results"),
    )
    if snapshot_date:
        out = out.withColumn("snapshot_date", F.to_date(F.lit(snapshot_date)))
    return out


def flatten_recalls(df: DataFrame) -> DataFrame:
    """Recall fields with the brand and generic lists joined by ``|`` (repeats kept, empty to null)."""
    def joined(name: str):
        return F.nullif(F.array_join(f"openfda.{name}", "|"), F.lit(""))

    return df.select(
        *RECALL_FIELDS, joined("brand_name").alias("brand_names"), joined("generic_name").alias("generic_names"))


def read_wide(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, list[str]]:
    """Wide rows as text, whatever columns the file has, and the years found in their names.

    The files hold JSON lines; with ``multiline`` each file is one document, parsed whole in one task.
    """
    df = spark.read.option("primitivesAsString", True).option("multiLine", multiline).json(path)
    return df, discover_suffixes(df)


def read_fx(spark: SparkSession, path: str) -> DataFrame:
    """Daily rates: date, currency, base currency, rate; blank rates dropped, sorted."""
    raw = spark.read.csv(path, header=True)
    rates = raw.select(
        F.to_date("TIME_PERIOD").alias("rate_date"),
        F.col("CURRENCY").alias("currency"),
        F.col("CURRENCY_DENOM").alias("base_currency"),
        F.col("OBS_VALUE").try_cast("double").alias("rate"))
    return stable_sort(drop_null(rates, "rate"), ["currency", "rate_date"])
