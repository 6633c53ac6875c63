"""Readers and writers on files that Spark writes from the given tables."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import item_count
from tallyward.gallery import Tables, query
from tallyward.gallery.readings import SEEDS_SQL, STUDIES_SQL, study_documents
from tallyward.gallery.spending import SPENDING_SQL, wide
from tallyward.operators import quality
from tallyward.operators.quality import Check
from tallyward.plans import staging
from tallyward.plans.measures import measure
from tallyward.plans.observability import run_results
from tallyward.plans.reports import layer_table
from tallyward.session import shared_folder
from tallyward.sources import delimited, documents, lake, runlog
from tallyward.sources.periods import quarter_label


def report_lines(t: Tables) -> DataFrame:
    """Reaction rows as delimited text; returned lines carry fields too many, line 7 ends early."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    tail = F.when(F.col("l_returnflag") == "R", "x$y$z").when(F.col("l_linenumber") == 7, F.lit(None)).otherwise("NA$")
    return t.lineitem.join(part, "l_partkey").select(
        F.concat_ws("$", F.col("l_orderkey").cast("string"), F.lit(""),
                    F.concat(F.lit("É\" "), "p_name"), tail).alias("line"))


@query("fixed_file", """SELECT pt, drug_rec_act, caseid, count(*) AS n FROM (
  SELECT 'É" ' || p_name AS pt, CASE WHEN l_linenumber != 7 THEN 'NA' END AS drug_rec_act, CAST(NULL AS VARCHAR) AS caseid
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag != 'R') GROUP BY 1, 2, 3
UNION ALL SELECT 'rejected', NULL, NULL, count(*) FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT p_name, NULL, CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY 1, 3
UNION ALL SELECT 'unexpected column brand', NULL, NULL, 1""")
def fixed_file(t: Tables) -> DataFrame:
    """Files with different headers read back to the fixed schema, with the rows that had to be rejected.

    The second file has its columns in another order, lacks one and has one too many.
    """
    path = shared_folder(t.spark, "reac-text")
    t.part.select(F.concat_ws("$", "p_name", "p_brand", F.col("p_size").cast("string"), F.lit("9")).alias(
        "PT$brand$CaseId$primaryid")).coalesce(1).write.options(
        header=True, quote="", sep="\x01", encoding="ISO-8859-1", emptyValue="").csv(path)
    report_lines(t).select(F.col("line").alias(" PrimaryID $CASEID$pt$drug_rec_act$")).write.mode("append").options(
        header=True, quote="", sep="\x01", encoding="ISO-8859-1", emptyValue="").csv(path)
    read = delimited.read_fixed(t.spark, path, delimited.REPORT_TABLES["reac"])
    good = read.rows.groupBy("pt", "drug_rec_act", "caseid").agg(F.count("*").alias("n"))
    bad = read.rejected.agg(F.count("*").alias("n")).select(
        F.lit("rejected").alias("pt"), F.lit(None).cast("string").alias("drug_rec_act"),
        F.lit(None).cast("string").alias("caseid"), "n")
    none = F.lit(None).cast("string")
    strange = read.unexpected.select(
        F.concat(F.lit("unexpected column "), "name").alias("pt"), none.alias("drug_rec_act"), none.alias("caseid"),
        F.lit(1).cast("bigint").alias("n"))
    return good.unionByName(bad).unionByName(strange)


@query("bronze_partitions", """SELECT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)
  AS quarter, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2""")
def bronze_partitions(t: Tables) -> DataFrame:
    """Quarters loaded once, loaded again without effect, one forced; read back with pruning off and on."""
    path = shared_folder(t.spark, "bronze-orders")
    orders = t.orders.select("o_orderkey", "o_orderstatus", quarter_label("o_orderdate").alias("quarter"))
    lake.write_partitions(orders.where("o_orderstatus = 'F'"), path, "quarter")
    lake.write_partitions(orders, path, "quarter")          # quarters are there: skipped
    lake.write_partitions(orders, path, "quarter", force=True)
    last = lake.read_bronze(t.spark, path, "2001Q3", ["quarter", "o_orderstatus"])
    rest = lake.read_bronze(t.spark, path, columns=["quarter", "o_orderstatus"]).where("quarter != '2001Q3'")
    return rest.unionByName(last).groupBy(F.col("quarter").cast("string").alias("quarter"), "o_orderstatus").agg(
        F.count("*").alias("n"))


@query("missing_quarters", """SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR)
  AS quarter FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F'
    AND date_trunc('quarter', o_orderdate) = date_trunc('quarter', l_shipdate))""")
def missing_quarters(t: Tables) -> DataFrame:
    """Ship quarters that one of two partitioned tables does not have yet."""
    done, full = shared_folder(t.spark, "bronze-a"), shared_folder(t.spark, "bronze-b")
    finished = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", quarter_label("o_orderdate").alias("quarter"))
    shipped = t.lineitem.select("l_orderkey", quarter_label("l_shipdate").alias("quarter"))
    lake.write_partitions(finished, done, "quarter")
    lake.write_partitions(shipped, full, "quarter")
    return lake.missing_partitions(shipped.select("quarter").distinct(), [done, full], "quarter")


@query("json_lines", """SELECT CAST(ts AS DATE) AS day, event_type, 2 * count(*) AS n FROM events GROUP BY 1, 2""")
def json_lines(t: Tables) -> DataFrame:
    """Gzip JSON lines with a field the table does not know, appended twice by day."""
    landed, table = shared_folder(t.spark, "json-landed"), shared_folder(t.spark, "json-table")
    lake.land_json(t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_type", "props"), landed)
    for _ in range(2):
        lake.append_json(t.spark, landed, _EVENT_JSON, table, "at", "day")
    return t.spark.read.parquet(table).groupBy(F.col("day").cast("date").alias("day"), "event_type").agg(
        F.count("*").alias("n"))


_EVENT_JSON = "event_id BIGINT, at STRING, event_type STRING"


@query("fx_file", """SELECT o_orderpriority AS currency, count(*) AS days, min(CAST(o_orderdate AS DATE)) AS first_day,
  round(max(o_totalprice), 4) AS top_rate FROM orders WHERE o_orderstatus != 'P' GROUP BY 1""")
def fx_file(t: Tables) -> DataFrame:
    """Rates as CSV with a blank value for status P."""
    path = shared_folder(t.spark, "fx")
    t.orders.select(
        F.lit("K").alias("KEY"), F.lit("D").alias("FREQ"), F.col("o_orderpriority").alias("CURRENCY"),
        F.lit("EUR").alias("CURRENCY_DENOM"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("TIME_PERIOD"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("OBS_VALUE")).write.csv(path, header=True)
    return documents.read_fx(t.spark, path).groupBy("currency").agg(
        F.count("*").alias("days"), F.min("rate_date").alias("first_day"), F.round(F.max("rate"), 4).alias("top_rate"))


@query("typed_seed", """SELECT n_name, n_regionkey > 2 AS is_far, count(*) AS customers
FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def typed_seed(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "nation-seed")
    t.nation.select("n_nationkey", "n_name", (F.col("n_regionkey") > 2).alias("is_far")).write.csv(path, header=True)
    seed = lake.read_seed(t.spark, path, "n_nationkey INT, n_name STRING, is_far BOOLEAN")
    return t.customer.join(seed, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "is_far").agg(
        F.count("*").alias("customers"))


@query("layer_volumes", """SELECT 'staging' AS layer, 'orders' AS table_id, count(*) AS layer_rows FROM orders
UNION ALL SELECT 'marts', 'lines', count(*) FROM lineitem WHERE l_returnflag = 'R'""")
def layer_volumes(t: Tables) -> DataFrame:
    mart = shared_folder(t.spark, "returned-lines")
    lake.write_table(t.lineitem.where("l_returnflag = 'R'"), mart)
    volumes = lake.layer_volumes(t.spark, lake.layer_paths({
        "staging": {"orders": t.path("orders")}, "marts": {"lines": mart}}))
    return layer_table(volumes).select("layer", "table_id", "layer_rows")


@query("clustered_table", """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey BETWEEN 3 AND 40 GROUP BY 1""")
def clustered_table(t: Tables) -> DataFrame:
    lines = lake.materialise(t.lineitem.select("l_suppkey", "l_orderkey"), "lines", cluster_by=["l_suppkey"])
    view = lake.materialise(lines, "lines_view", kind="view")
    return view.where("l_suppkey BETWEEN 3 AND 40").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("clustered_by_three", """SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS first_order FROM lineitem
WHERE l_suppkey BETWEEN 3 AND 9 AND l_shipdate >= TIMESTAMP '1999-01-01' AND l_shipdate < TIMESTAMP '1999-07-01' GROUP BY 1
UNION ALL SELECT 'by flag', count(*), min(l_orderkey) FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey = 7""")
def clustered_by_three(t: Tables) -> DataFrame:
    """Filters on two of three columns that share one layout."""
    lines = lake.materialise(t.lineitem.select("l_suppkey", "l_shipdate", "l_returnflag", "l_orderkey"), "lines",
                             cluster_by=["l_suppkey", "l_shipdate", "l_returnflag"])
    count = [F.count("*").alias("n"), F.min("l_orderkey").alias("first_order")]
    dated = lines.where("l_suppkey BETWEEN 3 AND 9 AND l_shipdate >= TIMESTAMP_NTZ '1999-01-01' "
                        "AND l_shipdate < TIMESTAMP_NTZ '1999-07-01'").groupBy("l_returnflag").agg(*count)
    flagged = lines.where("l_returnflag = 'R' AND l_suppkey = 7").agg(*count)
    return dated.unionByName(flagged.select(F.lit("by flag").alias("l_returnflag"), "n", "first_order"))


@query("run_log", """SELECT 'orders' AS source, 'success' AS status, count(*) AS rows_loaded, CAST(NULL AS VARCHAR)
  AS error_message FROM orders
UNION ALL SELECT 'broken', 'failed', 0, 'no such quarter'""")
def run_log(t: Tables) -> DataFrame:
    """A load that is counted while it is written, and one that fails; both leave a record."""
    log, target = shared_folder(t.spark, "run-log"), shared_folder(t.spark, "run-target")
    with runlog.RunRecord(t.spark, "orders", log) as run:
        rows, seen = runlog.observed(t.orders)
        lake.write_table(rows, target)
        run.loaded(seen.get["rows"], target=target)
    with suppress(LookupError), runlog.RunRecord(t.spark, "broken", log):
        raise LookupError("no such quarter")
    return t.spark.read.schema(runlog.RUN_SCHEMA).parquet(log).select("source", "status", "rows_loaded", "error_message")


@query("result_log", """SELECT invocation_id, 'orders.' || test AS node_name, status, failures FROM
  (VALUES ('i1'), ('i2')) AS i(invocation_id), (
  SELECT 'not_null:o_orderkey' AS test, 'pass' AS status, count(*) FILTER (o_orderkey IS NULL) AS failures FROM orders
  UNION ALL SELECT 'unique:o_custkey', 'fail', count(*) FROM (
    SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))""")
def result_log(t: Tables) -> DataFrame:
    log = shared_folder(t.spark, "result-log")
    results = quality.run_checks(t.orders, "orders", [Check("not_null", "o_orderkey"), Check("unique", "o_custkey")])
    for invocation in ("i1", "i2"):
        runlog.log_results(results, invocation, "2024-01-01 00:00:00", "prod", log)
    return t.spark.read.parquet(log).select("invocation_id", "node_name", "status", "failures")


@query("result_log_cost", """SELECT o_orderpriority AS node_name, CAST(o_orderdate AS DATE) AS run_date,
  round(CAST(sum(o_custkey) * 100000000 AS DOUBLE) / pow(1024, 4) * 6.25, 4) AS cost,
  round(CAST(sum(o_custkey) * 1000 AS DOUBLE) / 1000000000, 6) AS gb
FROM orders GROUP BY 1, 2""")
def result_log_cost(t: Tables) -> DataFrame:
    """Cost and volume of model runs, from the log they wrote: one run a year, nodes by priority and day."""
    log = shared_folder(t.spark, "model-log")
    nodes = t.orders.groupBy(F.col("o_orderpriority").alias("node_name"), F.to_date("o_orderdate").alias("day")).agg(
        F.sum("o_custkey").alias("units")).select(
        "node_name", F.date_format("day", "yyyy-MM-dd").alias("message"), F.lit("success").alias("status"),
        F.lit(1.5).alias("execution_time_sec"), (F.col("units") * 1000).alias("bytes_processed"),
        (F.col("units") * 100_000_000).alias("bytes_billed"))
    runlog.log_results(nodes, "i1", "2024-01-01 00:00:00", "prod", log, "model")
    runs = run_results(t.spark.read.schema(runlog.RESULT_SCHEMA).parquet(log))
    costs = measure(["cost_estimate", "gb_processed"], runs, ["node_name", "message"])
    return costs.select("node_name", F.col("message").cast("date").alias("run_date"),
                        F.round("cost_estimate", 4).alias("cost"), F.round("gb_processed", 6).alias("gb"))


@query("wide_json", f"""{SPENDING_SQL}
SELECT year, CAST(sum(total_spending_usd) AS DOUBLE) AS spend, count(*) AS n FROM pharmacy GROUP BY 1""")
def wide_json(t: Tables) -> DataFrame:
    """The wide file as JSON rows; the years are found in the column names."""
    path = shared_folder(t.spark, "wide-json")
    lake.land_json(wide(t), path)
    raw, years = documents.read_wide(t.spark, path, multiline=False)
    long = staging.stage_spending(raw, "Part D", years, {
        "brand_name": "Brnd_Name", "generic_name": "Gnrc_Name", "manufacturer": "Mftr_Name"})
    return long.groupBy("year").agg(F.sum("total_spending_usd").cast("double").alias("spend"), F.count("*").alias("n"))


@query("study_json", f"""WITH {SEEDS_SQL}, {STUDIES_SQL}
SELECT phases, countries IS NOT NULL AS has_country, CAST(sum(location_count) AS BIGINT) AS locations, count(*) AS n
FROM studies GROUP BY 1, 2""")
def study_json(t: Tables) -> DataFrame:
    """Nested studies landed as JSON lines, read with the explicit schema, flattened."""
    path = shared_folder(t.spark, "study-json")
    lake.land_json(study_documents(t), path)
    rows = documents.flatten_studies(documents.read_documents(t.spark, path, documents.STUDY_SCHEMA))
    return rows.groupBy("phases", (item_count("countries") > 0).alias("has_country")).agg(
        F.sum("location_count").alias("locations"), F.count("*").alias("n"))
