"""Interval overlap without a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overlaps_previous(df: DataFrame, key: str, start: str, end: str, slice_seconds: int = 3600,
                      name: str = "overlapped_previous_run") -> DataFrame:
    """Was an earlier-started interval of the same key still open at ``start``?

    True when another interval has a smaller start and an end after this start; a null end
    never counts. The answer depends on key and start alone, so intervals are first reduced
    to the latest end per start. Over these the running maximum answers in one pass: each
    key is cut into time slices, and a slice gets the maximum of all earlier slices. A hot
    key is spread over its slices and copies of one start collapse before they are sorted.
    """
    points = df.where(F.col(key).isNotNull() & F.col(start).isNotNull()).groupBy(
        F.col(key).alias("__key"), F.unix_micros(F.col(start).cast("timestamp")).alias("__s")
    ).agg(F.max(F.unix_micros(F.col(end).cast("timestamp"))).alias("__e")).withColumn(
        "__slice", F.floor(F.col("__s") / F.lit(slice_seconds * 1_000_000)))

    history = Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = points.groupBy("__key", "__slice").agg(F.max("__e").alias("__e")).select(
        "__key", "__slice", F.max("__e").over(history).alias("__carried"))
    inside = Window.partitionBy("__key", "__slice").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.greatest(F.max("__e").over(inside), F.col("__carried"))
    late = (
        points.join(carried, ["__key", "__slice"], "inner")
        .withColumn("__seen", seen).where(F.col("__seen") > F.col("__s"))
        .select("__key", "__s", F.lit(True).alias("__late"))
    )
    begins = F.unix_micros(F.col(start).cast("timestamp"))
    return (
        df.join(late, (F.col(key) == F.col("__key")) & (begins == F.col("__s")), "left")
        .withColumn(name, F.coalesce("__late", F.lit(False)))
        .drop("__key", "__s", "__late")
    )
