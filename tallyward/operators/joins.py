"""Equi joins of facts with aggregates, lookups and dimensions.

No join carries a broadcast hint: Spark broadcasts a side only when its known or
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, with adaptive splitting of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_latest(df: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Rows that belong to a latest case, with the case columns."""
    return df.join(latest, key, "inner")


def join_items(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Match child rows on report and sequence."""
    return left.join(right, list(on), "inner")


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys, on, "left_semi")


def orphans(df: DataFrame, col: str, to: DataFrame, field: str) -> DataFrame:
    """Rows whose non-null ``col`` has no match in ``to.field``."""
    parent = to.select(F.col(field).alias("__parent"))
    return df.where(F.col(col).isNotNull()).join(parent, F.col(col) == F.col("__parent"), "left_anti")


def enrich(df: DataFrame, lookup: DataFrame, key: str | Sequence[str],
           defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left join to a one-row-per-key frame; missing values take ``defaults``."""
    out = df.join(lookup, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def convert(df: DataFrame, fx: DataFrame, on: str, amount: str, rate: str, name: str) -> DataFrame:
    """Amount in another currency; a missing rate keeps the row with a null amount."""
    converted = F.col(amount).cast("double") * F.col(rate)
    return df.join(fx.select(on, rate), on, "left").withColumn(name, converted)


def with_total(df: DataFrame, total: DataFrame, name: str) -> DataFrame:
    """Every row with a one-value total, as a scalar subquery (nothing is joined)."""
    return df.withColumn(name, total.scalar())


def star(fact: DataFrame, dims: Mapping[str, DataFrame],
         relationships: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """Left join ``fact`` along active relationships ``(from, dim, key, active)``.

    A later relationship may start at a column an earlier dimension brought in.
    Dimension columns the fact already has are not repeated.
    """
    out = fact
    for source, dim, key, active in relationships:
        if not active:
            continue
        taken = set(out.columns)
        columns = [c for c in dims[dim].columns if c not in taken]
        side = dims[dim].select(F.col(key).alias("__dim_key"), *columns)
        out = out.join(side, F.col(source) == F.col("__dim_key"), "left").drop("__dim_key")
    return out


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond
