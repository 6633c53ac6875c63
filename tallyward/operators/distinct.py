"""Distinct counts that can be stored and merged: exact, without counting old rows again.

Every id gets a number, dense from 0. The ids of a group are kept per bucket of 32,768 numbers as a bitmap of 4 KB
(for groups that hold many ids) or as a list of positions (for many small groups). A new load adds its own cells; the
count of any union of cells is that of their merged bitmaps or lists. A stored row has a bounded size in both forms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET, CELL = "bucket", "ids"


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None, *,
                keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``(key, number)`` for the known keys, unchanged, and for those of ``keys`` that are new, numbered on from them.

    Null keys get no number. ``keep`` writes a frame and reads it back: the new keys are written before they are
    numbered, so their order cannot change. Keys are numbered within partitions; only one count per partition is summed
    up in one place.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known, key, "left_anti")
    placed = keep(fresh.withColumn("__at", F.monotonically_increasing_id()), "new_keys")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    first = 0 if known is None else known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("n")).first()["n"]
    numbered = placed.withColumn("__part", part).join(starts, "__part").select(
        key, (F.lit(first) + F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1)).alias("number"))
    return numbered if known is None else known.select(key, "number").unionAll(numbered)


def _bucket(number: Column) -> Column:
    return F.bitmap_bucket_number(number).alias(BUCKET)


def bitmap_cells(df: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """``(by, bucket, ids)`` with a bitmap per group and bucket; rows without a number count nowhere."""
    n = F.col(number)
    return df.where(n.isNotNull()).groupBy(*by, _bucket(n)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(CELL))


def list_cells(df: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """The same with a list of positions, which is smaller than a bitmap for up to a thousand ids of a bucket."""
    n = F.col(number)
    return df.where(n.isNotNull()).select(*by, _bucket(n), F.bitmap_bit_position(n).cast("int").alias("__at")).groupBy(
        *by, BUCKET).agg(F.collect_set("__at").alias(CELL))


def _merged(cells: DataFrame) -> Column:
    if dict(cells.dtypes)[CELL] == "binary":
        return F.bitmap_or_agg(CELL).alias(CELL)
    return F.array_distinct(F.flatten(F.collect_list(CELL))).alias(CELL)


def merge_cells(cells: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One cell per group and bucket from several tables of one form; ``by`` may be fewer columns than they have."""
    rows = reduce(DataFrame.unionAll, [c.select(*by, BUCKET, CELL) for c in cells])
    return rows.groupBy(*by, BUCKET).agg(_merged(rows))


def _size(cells: DataFrame) -> Column:
    return F.bitmap_count(CELL) if dict(cells.dtypes)[CELL] == "binary" else F.size(CELL).cast("bigint")


def count_cells(cells: DataFrame, by: Sequence[str], name: str = "cases") -> DataFrame:
    """Distinct ids per group, of cells that may repeat a group and bucket."""
    merged = merge_cells([cells], by)
    return merged.groupBy(*by).agg(F.sum(_size(merged)).alias(name))


def count_unions(cells: DataFrame, sets: Sequence[Sequence[str]], name: str = "cases") -> DataFrame:
    """Distinct ids for every list of columns in ``sets`` at once (columns left out are null, ``level`` is the list's
    place): totals are unions of stored cells, the rows behind them are not read again."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    kinds = dict(cells.dtypes)
    parts = []
    for level, own in enumerate(sets):
        found = count_cells(cells, own, name) if own else count_cells(cells.withColumn("__all", F.lit(0)), ["__all"], name)
        parts.append(found.select(
            F.lit(level).alias("level"), *[(F.col(c) if c in own else F.lit(None).cast(kinds[c])).alias(c) for c in columns],
            name))
    return reduce(DataFrame.unionAll, parts)


def matrix_of_cells(cells: DataFrame, rows: str, cols: str, values: Sequence[str], total_label: str = "Total") -> DataFrame:
    """Distinct ids by rows and columns with totals on both sides, each total the union of its cells."""
    kept = cells.where(F.col(cols).isin(list(values)))
    counts = count_unions(kept, [[rows, cols], [rows], [cols], []], "__cell").select(
        F.when(F.col("level") >= 2, F.lit(total_label)).otherwise(F.col(rows).cast("string")).alias(rows),
        F.when(F.col("level").isin(1, 3), F.lit(total_label)).otherwise(F.col(cols).cast("string")).alias("__col"), "__cell")
    return counts.groupBy(rows).agg(*[
        F.max(F.when(F.col("__col") == c, F.col("__cell"))).alias(c) for c in [*map(str, values), total_label]])
