"""Wide yearly spending to the converted spending mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.gallery import Tables, query
from tallyward.gallery.readings import SEEDS_SQL, aliases, products
from tallyward.operators.reshape import discover_suffixes
from tallyward.plans import spending, staging

MAKERS = "^(BUILDING|MACHINERY)"


def wide(t: Tables, clinic: bool = False) -> DataFrame:
    """Line revenue as the wide all-text file: one group of columns per order year.

    The pharmacy file is per brand, type and customer segment, the clinic file per brand,
    type and size. Fewer than three claims hide the beneficiaries behind a star.
    """
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("y"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity").join(
        orders, "l_orderkey").join(part, "l_partkey")
    if clinic:
        keys = [F.concat(F.lit("J"), F.col("p_size").cast("string")).alias("HCPCS_Cd"),
                F.concat(F.lit(" size "), F.col("p_size").cast("string")).alias("HCPCS_Desc"),
                F.col("p_brand").alias("Brnd_Name"), F.col("p_type").alias("Gnrc_Name")]
    else:
        people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        lines = lines.join(people, "o_custkey")
        keys = [F.concat("p_brand", F.lit("* ")).alias("Brnd_Name"), F.col("p_type").alias("Gnrc_Name"),
                F.concat(F.lower("c_mktsegment"), F.lit("*")).alias("Mftr_Name")]
    yearly = lines.groupBy(*keys, "y").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spend"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("units"), F.count(F.lit(1)).alias("claims"))
    cells = {"Tot_Spndng": F.col("spend").cast("string"), "Tot_Dsg_Unts": F.col("units").cast("string"),
             "Tot_Clms": F.col("claims").cast("string"),
             "Tot_Benes": F.when(F.col("claims") < 3, "*").otherwise(F.col("units").cast("string")),
             "Outlier_Flag": F.when(F.col("claims") > 9, "1").otherwise("0")}
    names = [c for c in yearly.columns if c not in ("y", "spend", "units", "claims")]
    return yearly.groupBy(*names).agg(*[
        F.max(F.when(F.col("y") == y, value)).alias(f"{stem}_{y}")
        for y in range(1995, 2002) for stem, value in cells.items()])


def pharmacy(t: Tables) -> DataFrame:
    raw = wide(t)
    return staging.stage_spending(raw, "Part D", discover_suffixes(raw), {
        "brand_name": "Brnd_Name", "generic_name": "Gnrc_Name", "manufacturer": "Mftr_Name"})


def clinic(t: Tables) -> DataFrame:
    raw = wide(t, clinic=True)
    return staging.stage_spending(raw, "Part B", discover_suffixes(raw), {
        "hcpcs_code": "HCPCS_Cd", "hcpcs_description": "HCPCS_Desc", "brand_name": "Brnd_Name",
        "generic_name": "Gnrc_Name", "manufacturer": None})


def fx_rates(t: Tables) -> DataFrame:
    """Mean order price per day and status as the rate of a currency; status P has none."""
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("rate_date"), "o_orderstatus").agg(price.alias("mean"))
    return staging.stage_fx(daily.select(
        "rate_date", F.when(F.col("o_orderstatus") == "F", "USD").when(F.col("o_orderstatus") == "O", "CHF")
        .otherwise("JPY").alias("currency"), F.lit("EUR").alias("base_currency"),
        F.when(F.col("o_orderstatus") != "P", F.col("mean")).alias("rate")))


def attributed(t: Tables) -> DataFrame:
    brands = aliases(t).where("alias_type = 'brand'")
    return spending.attributed_spending(pharmacy(t), clinic(t), brands, MAKERS)


def mart(t: Tables) -> DataFrame:
    """The yearly spending table, written: every measure starts from it."""
    rates = spending.daily_cross_rate(fx_rates(t), "USD", "CHF", "chf_per_usd")
    return t.layer("yearly_spending", lambda: spending.yearly_spending(attributed(t), rates))


SPENDING_SQL = f"""WITH {SEEDS_SQL},
lines AS (
  SELECT year(o_orderdate) AS year, p_brand, p_type, p_size, c_mktsegment, CAST(l_extendedprice AS DECIMAL(18, 2)) AS spend,
    CAST(l_quantity AS BIGINT) AS units
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  JOIN customer ON c_custkey = o_custkey),
pharmacy AS (
  SELECT 'Part D' AS program, upper(p_brand) AS brand_key, p_brand AS brand_name, p_type AS generic_name,
    lower(c_mktsegment) AS manufacturer, CAST(NULL AS VARCHAR) AS hcpcs_code, year, sum(spend) AS total_spending_usd,
    sum(units) AS dosage_units, count(*) AS claims, CASE WHEN count(*) >= 3 THEN sum(units) END AS beneficiaries,
    count(*) > 9 AS is_outlier FROM lines GROUP BY p_brand, p_type, c_mktsegment, year),
clinic AS (
  SELECT 'Part B' AS program, upper(p_brand) AS brand_key, p_brand AS brand_name, p_type AS generic_name,
    CAST(NULL AS VARCHAR) AS manufacturer, 'J' || CAST(p_size AS VARCHAR) AS hcpcs_code, year,
    sum(spend) AS total_spending_usd, sum(units) AS dosage_units, count(*) AS claims,
    CASE WHEN count(*) >= 3 THEN sum(units) END AS beneficiaries, count(*) > 9 AS is_outlier
  FROM lines GROUP BY p_brand, p_type, p_size, year),
attributed_spending AS (
  SELECT a.product_id, u.* FROM (
    SELECT * FROM pharmacy WHERE regexp_matches(upper(manufacturer), '^(BUILDING|MACHINERY)')
    UNION ALL SELECT * FROM clinic) u JOIN aliases a ON a.alias = u.brand_key AND a.alias_type = 'brand'),
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS rate_date,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderstatus = 'F') AS DOUBLE)
      / count(*) FILTER (o_orderstatus = 'F') AS base_rate,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderstatus = 'O') AS DOUBLE)
      / count(*) FILTER (o_orderstatus = 'O') AS quote_rate
  FROM orders GROUP BY 1),
rates AS (SELECT year(rate_date) AS year, avg(quote_rate / base_rate) AS rate FROM daily
  WHERE base_rate IS NOT NULL AND quote_rate IS NOT NULL GROUP BY 1),
yearly AS (
  SELECT product_id, program, year, CAST(sum(total_spending_usd) AS DOUBLE) AS spending_usd,
    CAST(sum(total_spending_usd) AS DOUBLE) * any_value(rate) AS spending_chf, any_value(rate) AS avg_chf_per_usd,
    CAST(sum(claims) AS BIGINT) AS claims, CAST(sum(beneficiaries) AS BIGINT) AS beneficiaries,
    CAST(sum(dosage_units) AS BIGINT) AS dosage_units
  FROM attributed_spending LEFT JOIN rates USING (year) GROUP BY 1, 2, 3),
dim_product AS (
  SELECT *, CASE WHEN generic_entry_year IS NOT NULL THEN 'Loss of exclusivity'
    WHEN approval_year >= 2016 THEN 'Growth (launched 2016+)' ELSE 'Established' END AS portfolio_segment,
    generic_entry_year IS NOT NULL AS faces_generic FROM products),
spend AS (SELECT * FROM yearly LEFT JOIN dim_product USING (product_id))
"""
_LONG = """program, brand_key, brand_name, generic_name, manufacturer, year,
  CAST(total_spending_usd AS DOUBLE) AS total_spending_usd, CAST(dosage_units AS DOUBLE) AS dosage_units,
  CAST(claims AS DOUBLE) AS claims, CAST(beneficiaries AS DOUBLE) AS beneficiaries, is_outlier"""


def _as_double(df: DataFrame) -> DataFrame:
    names = ("total_spending_usd", "dosage_units", "claims", "beneficiaries")
    return df.withColumns({c: F.col(c).cast("double") for c in names})


@query("unpivot_spend", f"{SPENDING_SQL} SELECT {_LONG} FROM pharmacy")
def unpivot_spend(t: Tables) -> DataFrame:
    return _as_double(pharmacy(t))


@query("unpivot_clinic", f"{SPENDING_SQL} SELECT {_LONG}, hcpcs_code, 'size ' || substr(hcpcs_code, 2) AS hcpcs_description FROM clinic")
def unpivot_clinic(t: Tables) -> DataFrame:
    return _as_double(clinic(t))


@query("attributed_spending", f"{SPENDING_SQL} SELECT product_id, {_LONG}, hcpcs_code FROM attributed_spending")
def attributed_spending(t: Tables) -> DataFrame:
    return _as_double(attributed(t))


@query("fx_cross_rate", f"""{SPENDING_SQL}
SELECT rate_date, year(rate_date) AS year, round(base_rate, 6) AS base_rate, round(quote_rate, 6) AS quote_rate,
  round(quote_rate / base_rate, 8) AS chf_per_usd FROM daily WHERE base_rate IS NOT NULL AND quote_rate IS NOT NULL""")
def fx_cross_rate(t: Tables) -> DataFrame:
    return spending.daily_cross_rate(fx_rates(t), "USD", "CHF", "chf_per_usd").withColumns({
        "base_rate": F.round("base_rate", 6), "quote_rate": F.round("quote_rate", 6),
        "chf_per_usd": F.round("chf_per_usd", 8)})


@query("yearly_spending", f"""{SPENDING_SQL}
SELECT md5(product_id || '-' || program || '-' || CAST(year AS VARCHAR)) AS spending_key, product_id, program, year,
  make_date(year, 1, 1) AS year_date, round(spending_usd, 2) AS spending_usd, round(spending_chf, 2) AS spending_chf,
  round(avg_chf_per_usd, 8) AS avg_chf_per_usd, claims, beneficiaries, dosage_units,
  round(spending_usd / beneficiaries, 6) AS spending_per_beneficiary_usd FROM yearly""")
def yearly_spending(t: Tables) -> DataFrame:
    return mart(t).withColumns({
        "spending_usd": F.round(F.col("spending_usd").cast("double"), 2), "spending_chf": F.round("spending_chf", 2),
        "avg_chf_per_usd": F.round("avg_chf_per_usd", 8),
        **{c: F.col(c).cast("bigint") for c in ("claims", "beneficiaries", "dosage_units")},
        "spending_per_beneficiary_usd": F.round("spending_per_beneficiary_usd", 6)})


@query("product_segments", f"""{SPENDING_SQL}
SELECT d.portfolio_segment, d.faces_generic, count(*) AS lines, CAST(sum(l.spend) AS DOUBLE) AS revenue
FROM lines l JOIN dim_product d ON upper(d.brand_name) = upper(l.p_brand) GROUP BY 1, 2""")
def product_segments(t: Tables) -> DataFrame:
    dim = spending.product_dimension(products(t)).withColumn("key", F.upper("brand_name"))
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.upper("p_brand").alias("key"))
    lines = t.lineitem.select("l_partkey", "l_extendedprice").join(part, "l_partkey").join(dim, "key")
    return lines.groupBy("portfolio_segment", "faces_generic").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"))
