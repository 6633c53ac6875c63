"""Spending mart: attribution, yearly totals and currency conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import cross_rate, ratio, segment, surrogate_key, year_start
from tallyward.operators.aggregates import mean_by, pivot_max, totals
from tallyward.operators.attribution import attribute_exact
from tallyward.operators.joins import convert
from tallyward.operators.reshape import drop_null, union_programs, where_matches
from tallyward.plans import rules

COLUMNS = ["program", "brand_key", "brand_name", "generic_name", "manufacturer", "hcpcs_code", "year",
           "total_spending_usd", "dosage_units", "claims", "beneficiaries", "is_outlier"]


def attributed_spending(part_d: DataFrame, part_b: DataFrame, aliases: DataFrame, maker_regex: str) -> DataFrame:
    """Pharmacy rows of the owner's makers and all clinic rows, matched to products by brand."""
    pharmacy = where_matches(part_d, "manufacturer", maker_regex).withColumn("hcpcs_code", F.lit(None).cast("string"))
    rows = union_programs(pharmacy.select(*COLUMNS), part_b.select(*COLUMNS))
    return attribute_exact(rows, aliases, "brand_key")


def daily_cross_rate(fx: DataFrame, base: str, quote: str, name: str) -> DataFrame:
    """Quote currency per base currency on each day that has both rates."""
    wide = pivot_max(fx, ["rate_date"], "currency", "rate", {base: "base_rate", quote: "quote_rate"})
    return drop_null(wide.withColumn(name, cross_rate("base_rate", "quote_rate")), name).withColumn(
        "year", F.year("rate_date").cast("bigint"))


def yearly_spending(spending: DataFrame, daily_rate: DataFrame, rate: str = "chf_per_usd") -> DataFrame:
    """Totals per product, program and year with the converted amount."""
    yearly = mean_by(daily_rate, ["year"], rate, f"avg_{rate}")
    sums = totals(spending, ["product_id", "program", "year"],
                  ["total_spending_usd", "claims", "beneficiaries", "dosage_units"]
                  ).withColumnRenamed("total_spending_usd", "spending_usd")
    converted = convert(sums, yearly, "year", "spending_usd", f"avg_{rate}", "spending_chf")
    return converted.select(
        surrogate_key("product_id", "program", "year").alias("spending_key"),
        "product_id", "program", "year", year_start("year").alias("year_date"), "spending_usd", "spending_chf",
        f"avg_{rate}", "claims", "beneficiaries", "dosage_units",
        ratio("spending_usd", "beneficiaries").alias("spending_per_beneficiary_usd"))


def product_dimension(products: DataFrame) -> DataFrame:
    """Products with their portfolio segment; loss of exclusivity decides before launch year."""
    entry = F.col("generic_entry_year")
    return products.withColumns({
        "portfolio_segment": segment([
            (entry.isNotNull(), rules.SEGMENT_LOE),
            (F.col("approval_year") >= rules.GROWTH_SINCE, rules.SEGMENT_GROWTH)], rules.SEGMENT_OTHER),
        "faces_generic": entry.isNotNull()})
