"""Proportional reporting ratio of product and reaction pairs.

                   reaction   other reactions
    product            a            b
    all others         c            d
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import ratio, safe_exp, safe_ln, safe_sqrt


def cells(pairs: DataFrame, product_totals: DataFrame, background: DataFrame, total: Column,
          product: str, item: str, min_cases: int) -> DataFrame:
    """The four cells, as doubles, of each pair with at least ``min_cases`` cases."""
    a, n_product, n_item = F.col("cases"), F.col("product_cases"), F.col("cases_with_reaction")
    return (
        pairs.where(a >= min_cases)
        .join(product_totals, product, "inner")
        .join(background, item, "inner")
        .select(
            product, item,
            a.cast("double").alias("a"),
            (n_product - a).cast("double").alias("b"),
            (n_item - a).cast("double").alias("c"),
            (total - n_product - (n_item - a)).cast("double").alias("d"))
    )


def disproportionality(pairs: DataFrame, product_totals: DataFrame, background: DataFrame, total: Column,
                       product: str = "product_id", item: str = "reaction_pt", min_cases: int = 3,
                       threshold: float = 2.0, chi: float = 4.0) -> DataFrame:
    """PRR, 95 % limits, Yates chi-square and the signal flag.

    Pairs that only this product reports (``c = 0``) have no ratio and are left out.
    """
    a, b, c, d = (F.col(x) for x in "abcd")
    n = a + b + c + d
    inverse = lambda x: ratio(F.lit(1.0), x)
    prr = ratio(ratio(a, a + b), ratio(c, c + d))
    se = safe_sqrt(inverse(a) - inverse(a + b) + inverse(c) - inverse(c + d))
    excess = F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0))
    chi_square = ratio(n * F.pow(excess, F.lit(2.0)), (a + b) * (c + d) * (a + c) * (b + d))
    stats = (
        cells(pairs, product_totals, background, total, product, item, min_cases)
        .where(c > 0)
        .withColumns({"prr": prr, "se_log_prr": se, "chi_square": chi_square})
    )
    ln = safe_ln("prr")
    return stats.select(
        product, item,
        a.cast("bigint").alias("cases_product_reaction"),
        (a + b).cast("bigint").alias("cases_product"),
        (a + c).cast("bigint").alias("cases_reaction_all_drugs"),
        ratio(a, a + b).alias("reporting_rate"),
        "prr",
        safe_exp(ln - 1.96 * F.col("se_log_prr")).alias("prr_lower_95"),
        safe_exp(ln + 1.96 * F.col("se_log_prr")).alias("prr_upper_95"),
        "chi_square",
        ((a >= min_cases) & (F.col("prr") >= threshold) & (F.col("chi_square") >= chi)).alias("is_signal"),
    )
