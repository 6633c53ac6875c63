"""Places of rows inside their key, without a task that holds a whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FIRST = -(1 << 63)


def in_key_order(df: DataFrame, key: str, offset: str) -> DataFrame:
    """Rows dealt by ranges of (key, offset) and sorted by both: read by partition, every key is in order.

    A key that holds most of the rows spreads over several partitions, each with a stretch of its offsets.
    """
    return df.repartitionByRange(key, offset).sortWithinPartitions(key, offset)


def number_in_key(df: DataFrame, key: str, offset: str, name: str = "place", ties: Sequence[str] = (),
                  span: int = 100_000) -> DataFrame:
    """Each row with its place (from 1) among the rows of its key by ``offset``, then ``ties``.

    The offsets are whole numbers. A window runs over stretches of ``span`` offsets of a key, so where offsets do not
    repeat it sees at most ``span`` rows, however many the key has; the rows before a stretch come from counts per
    stretch, which combine on the map side. Rows with a null key are one key; a null offset comes first. ``df`` is
    read twice: pass a table. The rows are shuffled once, their counts join on the same partitioning.
    """
    stretch = F.coalesce(F.col(offset) - F.pmod(F.col(offset), F.lit(span)), F.lit(_FIRST))
    # A struct is never null and equal to another with a null in the same place, so the join needs no null-safe test.
    keyed = df.select("*", F.struct(F.col(key).alias("k"), stretch.alias("s")).alias("__stretch"))
    sizes = keyed.groupBy("__stretch").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__stretch.k").orderBy("__stretch.s").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__stretch", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__stretch").orderBy(F.col(offset).asc_nulls_first(), *ties)
    placed = keyed.withColumn("__own", F.row_number().over(own))
    return placed.join(starts, "__stretch").withColumn(
        name, (F.col("__before") + F.col("__own")).cast("bigint")).drop("__stretch", "__before", "__own")
