"""Keep one row per key.

``row_number() = 1`` is planned with a partial group limit before the shuffle, so
each input task sends at most one row per key, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order`` (give a total order for a stable result)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dedup_events(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First delivery of each event id."""
    return latest_by(df, [key], [F.col(c).asc_nulls_last() for c in order])


def upsert_by_key(frames: Sequence[DataFrame], key: str, tie: Sequence[Column] = ()) -> DataFrame:
    """Union of pages where the last source wins for each key (null keys count as one)."""
    ranked = [df.withColumn("__source", F.lit(i)) for i, df in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    return latest_by(merged, [key], [F.col("__source").desc(), *tie]).drop("__source")


def first_with_count(df: DataFrame, by: Sequence[str], order: Sequence[Column], columns: Sequence[str],
                     name: str = "group_count") -> DataFrame:
    """``columns`` of the first row per group and the size of the group, in one aggregation.

    ``order`` sorts ascending; negate a number to sort it the other way.
    """
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*by).agg(first.alias("__first"), F.count(F.lit(1)).alias(name)).select(
        *by, "__first.*", name)


def with_group_count(df: DataFrame, by: Sequence[str], name: str = "group_count") -> DataFrame:
    """Every row with the number of rows of its group.

    A count and a join instead of a window: no task has to hold a whole group. ``df`` is
    read twice, so pass a table rather than a long chain of work.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    keys = [F.col(c).alias(f"__{c}") for c in by]
    counts = counts.select(*keys, name)
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    return df.join(counts, cond, "inner").drop(*[f"__{c}" for c in by])
