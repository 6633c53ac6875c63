"""Runs, data tests, profiles, calendars, matrices and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import calendar_columns, first_where, has, item_total, scan_cost, surrogate_key
from tallyward.gallery import Tables, query
from tallyward.gallery.readings import RUNS_SQL, runs
from tallyward.operators import aggregates, dedup, distinct, joins, quality, ranking, reshape
from tallyward.operators.nesting import nest
from tallyward.operators.quality import Check
from tallyward.plans.checks import FRESHNESS_DAYS
from tallyward.sources import lake
from tallyward.sources.periods import quarter_label, quarter_labels, quarter_range, recent_quarters


@query("overlap_runs", f"WITH {RUNS_SQL} SELECT run_id, source, run_date, overlapped_previous_run FROM runs")
def overlap_runs(t: Tables) -> DataFrame:
    return runs(t).select("run_id", "source", "run_date", "overlapped_previous_run")


@query("quality_report", """
SELECT 'lineitem' AS table_name, 'not_null:l_orderkey' AS test_name,
  count(*) FILTER (l_orderkey IS NULL) AS failures, 'pass' AS status FROM lineitem
UNION ALL SELECT 'lineitem', 'expression_is_true:l_quantity >= 2', count(*) FILTER (NOT l_quantity >= 2),
  CASE WHEN count(*) FILTER (NOT l_quantity >= 2) = 0 THEN 'pass' ELSE 'fail' END FROM lineitem
UNION ALL SELECT 'lineitem', 'unique:l_orderkey', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
  FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'unique_combination:l_orderkey_l_linenumber', count(*),
  CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
  FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'accepted_values:l_returnflag', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
  FROM (SELECT l_returnflag FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 1)
UNION ALL SELECT 'lineitem', 'relationships:l_orderkey', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
  FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'relationships:l_suppkey', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
  FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def quality_report(t: Tables) -> DataFrame:
    return quality.run_checks(t.lineitem, "lineitem", [
        Check("not_null", "l_orderkey"),
        Check("expression_is_true", expression="l_quantity >= 2"),
        Check("unique", "l_orderkey"),
        Check("unique_combination", columns=("l_orderkey", "l_linenumber")),
        Check("accepted_values", "l_returnflag", values=("A", "N")),
        Check("relationships", "l_orderkey", to=t.orders, field_name="o_orderkey"),
        Check("relationships", "l_suppkey", to=t.supplier.where("s_acctbal > 0"), field_name="s_suppkey"),
    ])


@query("pass_rate", """
SELECT 3 AS tests_run, CAST(a + b + c AS BIGINT) AS tests_passed, round((a + b + c) / 3.0, 6) AS pass_rate FROM (
  SELECT CASE WHEN count(*) FILTER (o_orderkey IS NULL) = 0 THEN 1 ELSE 0 END AS a,
    CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 1 ELSE 0 END AS b,
    CASE WHEN count(*) = count(DISTINCT o_custkey) THEN 1 ELSE 0 END AS c FROM orders)""")
def pass_rate(t: Tables) -> DataFrame:
    results = quality.run_checks(t.orders, "orders", [
        Check("not_null", "o_orderkey"), Check("unique", "o_orderkey"), Check("unique", "o_custkey")])
    return quality.pass_rate(results).withColumn("pass_rate", F.round("pass_rate", 6))


@query("failing_rows", """
SELECT 'duplicate' AS test, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key, count(*) AS n
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'value', l_returnflag, count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 2
UNION ALL SELECT 'false', l_linestatus, count(*) FROM lineitem WHERE NOT l_quantity >= 2 GROUP BY 2
UNION ALL SELECT 'null', 'l_partkey', count(*) FROM lineitem WHERE l_partkey IS NULL""")
def failing_rows(t: Tables) -> DataFrame:
    lines = t.lineitem
    pair = F.concat_ws("-", "l_orderkey", "l_linenumber")
    duplicates = quality.unique_combination(lines, ["l_orderkey", "l_linenumber"])
    values = quality.accepted_values(lines, "l_returnflag", ["A", "N"])
    false = quality.expression_is_true(lines, "l_quantity >= 2").groupBy("l_linestatus").agg(F.count("*").alias("n"))
    null = quality.not_null(lines, "l_partkey").agg(F.count("*").alias("n"))
    return reshape.union_programs(
        duplicates.select(F.lit("duplicate").alias("test"), pair.alias("key"), F.col("n_records").alias("n")),
        values.select(F.lit("value").alias("test"), F.col("l_returnflag").alias("key"), F.col("n_records").alias("n")),
        false.select(F.lit("false").alias("test"), F.col("l_linestatus").alias("key"), "n"),
        null.select(F.lit("null").alias("test"), F.lit("l_partkey").alias("key"), "n"))


@query("orphans", """SELECT l_suppkey, count(*) AS n FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1""")
def orphans(t: Tables) -> DataFrame:
    bad = quality.relationships(t.lineitem, "l_suppkey", t.supplier.where("s_acctbal > 0"), "s_suppkey")
    return bad.groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("freshness", """SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS max_loaded,
  CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-05') // 1000000 AS BIGINT) AS age_seconds,
  CASE WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-02-05') // 1000000 > 7 * 86400 THEN 'error'
    WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-02-05') // 1000000 > 2 * 86400 THEN 'warn' ELSE 'pass' END
  AS status FROM events""")
def freshness(t: Tables) -> DataFrame:
    warn, error = FRESHNESS_DAYS["ingestion_runs"]
    out = quality.freshness(t.events, "ts", "2024-02-05", warn_days=warn, error_days=error)
    return out.select(F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm").alias("max_loaded"), "age_seconds", "status")


_PROFILED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"]


@query("profile", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (v IS NULL) AS n_null, count(DISTINCT v) AS n_distinct,
  CAST(min(x) AS VARCHAR) AS min_value, CAST(max(x) AS VARCHAR) AS max_value, round(avg(TRY_CAST(x AS DOUBLE)), 6) AS mean_value,
  (SELECT CAST({c} AS VARCHAR) FROM lineitem GROUP BY 1
  ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS top_value FROM (SELECT CAST({c} AS VARCHAR) AS v, {c} AS x FROM lineitem)"""
                               for c in _PROFILED))
def profile(t: Tables) -> DataFrame:
    return aggregates.profile(t.lineitem, _PROFILED).withColumn("mean_value", F.round("mean_value", 6))


@query("code_distributions", """
SELECT 'status' AS kind, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'flag', l_returnflag, count(*) FROM lineitem GROUP BY 2""")
def code_distributions(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    lines = t.lineitem.select(F.col("l_returnflag").alias("flag"))
    return reshape.union_programs(
        aggregates.distributions(orders, ["status", "priority"], "kind"),
        aggregates.distributions(lines, ["flag"], "kind"))


@query("head_by_count", """SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 30""")
def head_by_count(t: Tables) -> DataFrame:
    return ranking.head_by_count(t.lineitem, "l_suppkey", 30)


@query("volumes", """SELECT coalesce(l_returnflag, 'TOTAL') AS l_returnflag, count(*) AS n,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units FROM lineitem GROUP BY ROLLUP (l_returnflag)""")
def volumes(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", F.lit(1).cast("bigint").alias("n"), F.col("l_quantity").cast("bigint").alias("units"))
    return aggregates.volumes(rows, "l_returnflag", ["n", "units"])


@query("search_all", """SELECT p_brand, count(*) AS n FROM part
WHERE regexp_matches(upper(p_name), 'RING') OR regexp_matches(upper(p_type), 'PROMO') GROUP BY 1""")
def search_all(t: Tables) -> DataFrame:
    found = reshape.search_all(t.part, "RING|PROMO")
    return found.groupBy("p_brand").agg(F.count("*").alias("n"))


@query("json_props", """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_props(t: Tables) -> DataFrame:
    return t.events.select(F.from_json("props", "k BIGINT").getField("k").alias("k")).groupBy("k").agg(
        F.count("*").alias("n"))


@query("scan_costs", """SELECT l_returnflag,
  round(CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS DOUBLE) * 1000 / pow(1024, 4) * 6.25, 4) AS cost
FROM lineitem GROUP BY 1""")
def scan_costs(t: Tables) -> DataFrame:
    size = F.sum(F.floor("l_extendedprice")) * 1000
    return t.lineitem.groupBy("l_returnflag").agg(size.alias("b")).select("l_returnflag", scan_cost("b").alias("cost"))


@query("date_dim", """
SELECT CAST(d AS DATE) AS date_day, year(d) AS year, quarter(d) AS quarter_number,
  CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter, month(d) AS month_number,
  strftime(d, '%b') AS month_name, strftime(d, '%Y-%m') AS year_month, CAST(date_trunc('month', d) AS DATE) AS month_start,
  weekofyear(d) AS iso_week, strftime(d, '%a') AS weekday_name, coalesce(n, 0) AS orders
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
LEFT JOIN (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY 1) ON o_orderdate = d""")
def date_dim(t: Tables) -> DataFrame:
    """The calendar of the order dates with the orders of each day."""
    day = F.to_date("o_orderdate")
    bounds = t.orders.agg(F.min(day).alias("start_date"), F.date_add(F.max(day), 1).alias("end_date"))
    per_day = t.orders.groupBy(day.alias("date_day")).agg(F.count("*").alias("orders"))
    return joins.enrich(reshape.date_dim(bounds), per_day, "date_day", {"orders": 0})


@query("quarters", """
SELECT CAST(year(q) AS VARCHAR) || 'Q' || CAST(quarter(q) AS VARCHAR) AS quarter,
  (SELECT count(*) FROM orders WHERE date_trunc('quarter', o_orderdate) = q) AS orders
FROM (SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate)),
  date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS q FROM orders)""")
def quarters(t: Tables) -> DataFrame:
    span = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    wanted = span.select(F.explode(quarter_labels("a", "b")).alias("quarter"))
    counts = t.orders.groupBy(quarter_label("o_orderdate").alias("quarter")).agg(F.count("*").alias("orders"))
    return joins.enrich(wanted, counts, "quarter", {"orders": 0})


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_CELLS = ", ".join(f"max(v) FILTER (s = '{s}') AS {s}" for s in [*_SEGMENTS, "Total"])


def _segment_orders(t: Tables) -> DataFrame:
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.join(people, "o_custkey").withColumn("year", F.year("o_orderdate"))


@query("matrix_totals", f"""SELECT y AS year, {_CELLS} FROM (
  SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'Total') AS y, coalesce(c_mktsegment, 'Total') AS s, count(*) AS v
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY CUBE (year(o_orderdate), c_mktsegment)) GROUP BY 1""")
def matrix_totals(t: Tables) -> DataFrame:
    return aggregates.matrix(_segment_orders(t), "year", "c_mktsegment", _SEGMENTS)


@query("matrix_distinct", f"""SELECT y AS year, {_CELLS} FROM (
  SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'Total') AS y, coalesce(o_orderstatus, 'Total') AS s,
    count(DISTINCT o_custkey) AS v
  FROM orders GROUP BY CUBE (year(o_orderdate), o_orderstatus)) GROUP BY 1""".replace(
    _CELLS, ", ".join(f"max(v) FILTER (s = '{s}') AS {s}" for s in ["F", "O", "P", "Total"])))
def matrix_distinct(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("year", F.year("o_orderdate"))
    return aggregates.matrix(orders, "year", "o_orderstatus", ["F", "O", "P"], distinct="o_custkey")


def _customer_cells(t: Tables) -> DataFrame:
    """Bitmaps of customers by order year and status, from two loads that share customers."""
    numbers = distinct.number_keys(t.orders, "o_custkey", keep=lake.materialise)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year")).join(
        numbers, "o_custkey")
    by = ["year", "o_orderstatus"]
    loads = [distinct.bitmap_cells(orders.where(f"o_orderkey % 2 = {i}"), by) for i in (0, 1)]
    return lake.materialise(distinct.merge_cells(loads, by), "customer_cells")


@query("merged_matrix", f"""SELECT y AS year, {_CELLS} FROM (
  SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'Total') AS y, coalesce(o_orderstatus, 'Total') AS s,
    count(DISTINCT o_custkey) AS v
  FROM orders GROUP BY CUBE (year(o_orderdate), o_orderstatus)) GROUP BY 1""".replace(
    _CELLS, ", ".join(f"max(v) FILTER (s = '{s}') AS {s}" for s in ["F", "O", "P", "Total"])))
def merged_matrix(t: Tables) -> DataFrame:
    """The distinct matrix from stored bitmaps; its totals are unions of cells."""
    return distinct.matrix_of_cells(_customer_cells(t), "year", "o_orderstatus", ["F", "O", "P"])


@query("customers_to_date", """SELECT y.year, count(DISTINCT o_custkey) AS customers
FROM (SELECT DISTINCT year(o_orderdate) AS year FROM orders) y JOIN orders ON year(o_orderdate) <= y.year GROUP BY 1""")
def customers_to_date(t: Tables) -> DataFrame:
    """Customers up to each year: a year's cell counts in every later year, no order is read twice."""
    cells = distinct.merge_cells([_customer_cells(t)], ["year"])
    last = cells.agg(F.max("year").alias("last"))
    later = cells.withColumn("last", last.scalar()).select(
        F.explode(F.sequence("year", "last")).alias("year"), distinct.BUCKET, distinct.CELL)
    present = cells.select("year").distinct()
    return joins.restrict_to(distinct.count_cells(later, ["year"], "customers"), present, "year")


@query("load_quarters", """SELECT kind, CAST(year(q) AS VARCHAR) || 'Q' || CAST(quarter(q) AS VARCHAR) AS quarter,
  (SELECT count(*) FROM orders WHERE date_trunc('quarter', o_orderdate) = q) AS orders
FROM (SELECT 'range' AS kind, unnest(generate_series(DATE '1999-07-01', DATE '2000-10-01', INTERVAL 3 MONTH)) AS q
  UNION ALL SELECT 'recent', unnest(generate_series(DATE '2000-04-01', DATE '2001-04-01', INTERVAL 3 MONTH)))""")
def load_quarters(t: Tables) -> DataFrame:
    """Orders of a range of quarters, and of the five quarters completed before a day."""
    wanted = [quarter_range(t.spark, "1999Q3", "2000Q4").withColumn("kind", F.lit("range")),
              recent_quarters(t.spark, 5, "2001-09-29").withColumn("kind", F.lit("recent"))]
    counts = t.orders.groupBy(quarter_label("o_orderdate").alias("quarter")).agg(F.count("*").alias("orders"))
    return joins.enrich(wanted[0].unionByName(wanted[1]), counts, "quarter", {"orders": 0})


@query("nest_orders", """
SELECT o_orderkey, CAST(count(l_orderkey) AS BIGINT) AS n_lines, min(l_partkey) FILTER (l_linenumber = 1) AS first_part,
  coalesce(bool_or(l_returnflag = 'R'), false) AS has_return,
  string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS brands
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def nest_orders(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_returnflag")
    docs = nest(t.orders.select("o_orderkey"), {
        "lines": (lines, ["l_linenumber", "l_partkey"]),
        "flags": (lines, ["l_returnflag"]),
        "brands": (lines.join(part, "l_partkey"), ["brand"])}, "o_orderkey")
    return docs.select(
        "o_orderkey", item_total("lines").alias("n_lines"),
        first_where("lines", lambda x: x["l_linenumber"] == 1)["l_partkey"].alias("first_part"),
        has("flags", "R").alias("has_return"),
        F.nullif(F.array_join(F.array_distinct("brands"), "|"), F.lit("")).alias("brands"))


@query("upsert_pages", """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'size' WHEN p_type = 'PROMO' THEN 'promo' ELSE 'all' END
  AS source, p_brand FROM part""")
def upsert_pages(t: Tables) -> DataFrame:
    page = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    pages = [page.withColumn("source", F.lit("all")), page.where("p_type = 'PROMO'").withColumn("source", F.lit("promo")),
             page.where("p_size > 40").withColumn("source", F.lit("size"))]
    return dedup.upsert_by_key(pages, "p_partkey").select("p_partkey", "source", "p_brand")


@query("dedup_events", """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dedup_events(t: Tables) -> DataFrame:
    first = dedup.dedup_events(t.events, "user_id", ["ts", "event_id"])
    return first.select("user_id", "event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query("group_count", """SELECT l_partkey, l_orderkey, count(*) OVER (PARTITION BY l_partkey) AS group_count FROM lineitem""")
def group_count(t: Tables) -> DataFrame:
    return dedup.with_group_count(t.lineitem.select("l_partkey", "l_orderkey"), ["l_partkey"])


@query("star_join", """SELECT c_mktsegment, n_name, r_name, count(*) AS orders FROM orders
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3""")
def star_join(t: Tables) -> DataFrame:
    dims = {"customer": t.customer, "nation": t.nation, "region": t.region, "supplier": t.supplier}
    wide = joins.star(t.orders, dims, [
        ("o_custkey", "customer", "c_custkey", True), ("c_nationkey", "nation", "n_nationkey", True),
        ("n_regionkey", "region", "r_regionkey", True), ("o_custkey", "supplier", "s_suppkey", False)])
    return wide.groupBy("c_mktsegment", "n_name", "r_name").agg(F.count("*").alias("orders"))


@query("slice_rows", """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW', '3-MEDIUM') GROUP BY 1, 2 HAVING count(*) > 100""")
def slice_rows(t: Tables) -> DataFrame:
    kept = reshape.slice_rows(t.orders, keep={"o_orderstatus": ["F", "O"]},
                              drop={"o_orderpriority": ["5-LOW", "3-MEDIUM", None]})
    return kept.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).where("n > 100")


def _revenue():
    return F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))


@query("top_n", """SELECT p_brand, CAST(revenue AS DOUBLE) AS revenue FROM (
  SELECT p_brand, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS revenue,
    rank() OVER (ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18, 2))) DESC) AS r
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) WHERE r <= 10""")
def top_n(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    brands = t.lineitem.join(part, "l_partkey").groupBy("p_brand").agg(_revenue().alias("revenue"))
    return ranking.top_n(brands, "revenue", 10).withColumn("revenue", F.col("revenue").cast("double")).orderBy(
        F.col("revenue").desc())


@query("top_n_filter", """SELECT p_type, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand IN (SELECT p_brand FROM (
  SELECT p_brand, rank() OVER (ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18, 2))) DESC) AS r
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) WHERE r <= 10) GROUP BY 1""")
def top_n_filter(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    lines = t.lineitem.select("l_partkey", "l_extendedprice").join(part, "l_partkey")
    return ranking.top_n_filter(lines, "p_brand", _revenue(), 10).groupBy("p_type").agg(
        F.count("*").alias("lines"), _revenue().cast("double").alias("revenue"))


@query("prior_period", """WITH y AS (SELECT l_suppkey, year(l_shipdate) AS year, count(*) AS lines FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, year, y.lines, p.lines AS lines_before FROM y FULL JOIN
  (SELECT l_suppkey, year + 1 AS year, lines FROM y) p USING (l_suppkey, year)""")
def prior_period(t: Tables) -> DataFrame:
    yearly = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").cast("bigint").alias("year")).agg(
        F.count("*").alias("lines"))
    return ranking.prior_period(yearly, ["l_suppkey"], "year", "lines", "lines_before", include_gone=True)


@query("prior_period_window", """WITH y AS (
  SELECT o_custkey, year(o_orderdate) AS year, count(*) AS orders FROM orders GROUP BY 1, 2)
SELECT o_custkey, year, y.orders, p.orders AS orders_before FROM y LEFT JOIN
  (SELECT o_custkey, year + 1 AS year, orders FROM y) p USING (o_custkey, year)""")
def prior_period_window(t: Tables) -> DataFrame:
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.count("*").alias("orders"))
    return ranking.prior_period(yearly, ["o_custkey"], "year", "orders", "orders_before")


@query("surrogate_keys", """SELECT md5(coalesce(n_name, '_dbt_utils_surrogate_key_null_') || '-'
  || coalesce(c_mktsegment, '_dbt_utils_surrogate_key_null_')) AS key, count(*) AS n
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey != 1) ON n_nationkey = c_nationkey GROUP BY 1""")
def surrogate_keys(t: Tables) -> DataFrame:
    known = t.nation.where("n_regionkey != 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    people = t.customer.join(known, "c_nationkey", "left")
    return people.groupBy(surrogate_key("n_name", "c_mktsegment").alias("key")).agg(F.count("*").alias("n"))


@query("calendar_parts", """SELECT year(ts) AS year, quarter(ts) AS quarter_number,
  CAST(year(ts) AS VARCHAR) || 'Q' || CAST(quarter(ts) AS VARCHAR) AS year_quarter, month(ts) AS month_number,
  strftime(ts, '%b') AS month_name, strftime(ts, '%Y-%m') AS year_month, CAST(date_trunc('month', ts) AS DATE) AS month_start,
  weekofyear(ts) AS iso_week, strftime(ts, '%a') AS weekday_name, count(*) AS events FROM events GROUP BY ALL""")
def calendar_parts(t: Tables) -> DataFrame:
    return t.events.groupBy(*calendar_columns(F.to_date("ts"))).agg(F.count("*").alias("events"))
