"""Grouped counts, sums, pivots, totals and profiles.

Distinct counts are written as de-duplicate, then count: both steps combine on the
map side, so a hot group costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import ratio


def totals(df: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])


def case_counts(df: DataFrame, case: str, item: str, name: str = "cases_with_reaction") -> DataFrame:
    """Number of cases that report each item."""
    return df.select(case, item).where(F.col(case).isNotNull()).distinct().groupBy(item).agg(F.count(F.lit(1)).alias(name))


def pair_counts(products: DataFrame, items: DataFrame, case: str, product: str, item: str,
                name: str = "cases") -> DataFrame:
    """Cases per product and item. Items of cases without a product go before anything is made distinct."""
    owners = products.select(case, product).distinct()
    reported = items.select(case, item).join(owners.select(case), case, "left_semi").distinct()
    pairs = owners.join(reported, case)
    return pairs.groupBy(product, item).agg(F.count(F.lit(1)).alias(name))


def group_cases(df: DataFrame, by: str, case: str, name: str) -> DataFrame:
    """Distinct cases per group."""
    return df.select(by, case).where(F.col(case).isNotNull()).distinct().groupBy(by).agg(F.count(F.lit(1)).alias(name))


def total_cases(df: DataFrame, name: str = "total_cases") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def share_of_total(parts: DataFrame, whole: DataFrame, by: str, part: str, case: str,
                   min_share: float = 0.0) -> DataFrame:
    """Distinct cases per (group, part) and their share of all the group's cases.

    ``whole`` holds every case of the group, also those without any part.
    """
    counts = parts.select(by, part, case).where(F.col(case).isNotNull()).distinct().groupBy(by, part).agg(F.count(F.lit(1)).alias("cases"))
    sizes = group_cases(whole, by, case, "product_cases")
    return (
        counts.join(sizes, by, "inner")
        .withColumn("share_of_product_cases", ratio("cases", "product_cases"))
        .where(F.col("share_of_product_cases") >= min_share)
        .drop("product_cases")
    )


def any_flag(code: str, value) -> Column:
    """Aggregate: does the code occur in the group? Null when the group has only nulls."""
    return F.bool_or(F.col(code) == F.lit(value))


def codes_text(code: str, sep: str = "|") -> Column:
    """Aggregate: distinct codes in order, joined; no code gives null. Meant for short code lists."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(code)), sep), F.lit(""))


def pivot_max(df: DataFrame, by: Sequence[str], on: str, value: str, names: Mapping[object, str]) -> DataFrame:
    """One column per listed value of ``on`` with the maximum of ``value``."""
    return df.groupBy(*by).agg(*[F.max(F.when(F.col(on) == v, F.col(value))).alias(n) for v, n in names.items()])


def mean_by(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(name))


def volumes(df: DataFrame, by: str, sums: Sequence[str], total_label: str = "TOTAL") -> DataFrame:
    """Sums per group and one total line; the roll-up runs on the grouped sums."""
    grouped = df.groupBy(by).agg(*[F.sum(c).alias(c) for c in sums])
    return (
        grouped.rollup(by)
        .agg(F.grouping(by).alias("__total"), *[F.sum(c).alias(c) for c in sums])
        .withColumn(by, F.when(F.col("__total") == 1, F.lit(total_label)).otherwise(F.col(by).cast("string")))
        .drop("__total")
    )


def distributions(df: DataFrame, columns: Sequence[str], name: str = "column") -> DataFrame:
    """Rows per value of every listed column, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy(name, "value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest, largest, mean and most frequent value.

    Smallest and largest follow the column's own type and are shown as text; the mean is
    null for columns that are no numbers.
    """
    kinds = dict(df.dtypes)
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

    def facts(c: str) -> Column:
        mean = F.avg(c).cast("double") if kinds[c].startswith(numbers) else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("__column"), F.min(c).cast("string").alias("min_value"),
                        F.max(c).cast("string").alias("max_value"), mean.alias("mean_value"))

    typed = df.agg(F.array(*[facts(c) for c in columns]).alias("__facts")).select(F.inline("__facts"))
    dist = distributions(df, columns)
    top = F.max_by("value", F.when(F.col("value").isNotNull(), F.struct("n", "value")))
    counts = dist.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        top.alias("top_value"),
    )
    return counts.join(typed, F.col("column") == F.col("__column")).drop("__column")


def matrix(df: DataFrame, rows: str, cols: str, values: Sequence[str], sum_of: str | None = None,
           distinct: str | None = None, total_label: str = "Total") -> DataFrame:
    """Rows by columns with totals on both sides.

    Sums (or row counts) are added up from the cells; distinct counts are recomputed
    for each total from de-duplicated ids.
    """
    kept = df.where(F.col(cols).isin(list(values)))
    if distinct:
        base = kept.select(rows, cols, distinct).distinct()
        cell = F.count_distinct(F.col(distinct))
    else:
        measure = F.sum(sum_of) if sum_of else F.count(F.lit(1))
        base = kept.groupBy(rows, cols).agg(measure.alias("__v"))
        cell = F.sum("__v")
    cube = base.cube(rows, cols).agg(
        F.grouping(rows).alias("__gr"), F.grouping(cols).alias("__gc"), cell.alias("__cell"))
    named = cube.select(
        F.when(F.col("__gr") == 1, F.lit(total_label)).otherwise(F.col(rows).cast("string")).alias(rows),
        F.when(F.col("__gc") == 1, F.lit(total_label)).otherwise(F.col(cols).cast("string")).alias("__col"),
        "__cell")
    labels = [str(v) for v in values] + [total_label]
    return named.groupBy(rows).agg(*[
        F.max(F.when(F.col("__col") == c, F.col("__cell"))).alias(c) for c in labels])
