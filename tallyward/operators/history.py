"""Type 2 history from full snapshots, without a table format."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def start_history(incoming: DataFrame, as_of: str) -> DataFrame:
    """First version of every key."""
    return incoming.withColumns({
        "valid_from": F.to_date(F.lit(as_of)), "valid_to": F.lit(None).cast("date")})


def open_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col("valid_to").isNull())


def scd2_step(current: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: str) -> DataFrame:
    """Open versions after a snapshot (one row per key) taken at ``as_of``, with those it closed.

    A new key or a null-safe change in ``check_cols`` opens a version; the changed
    version is closed. Other columns do not open one, and a key missing from the
    snapshot stays open. The same snapshot again changes nothing.
    """
    columns = [c for c in current.columns if c not in ("valid_from", "valid_to")]
    at = F.to_date(F.lit(as_of))

    old = current.select(F.col(key).alias("__old_key"), F.struct(*columns, "valid_from").alias("__old"))
    new = incoming.select(F.col(key).alias("__new_key"), F.struct(*columns).alias("__new"))
    both = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")

    present = F.col("__old").isNotNull() & F.col("__new").isNotNull()
    differs = reduce(lambda a, b: a | b, [
        ~F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")) for c in check_cols])
    changed = present & differs

    kept = F.when(F.col("__old").isNotNull(), F.struct(
        *[F.col(f"__old.{c}") for c in columns], F.col("__old.valid_from"),
        F.when(changed, at).alias("valid_to")))
    opened = F.when(changed | F.col("__old").isNull(), F.struct(
        *[F.col(f"__new.{c}") for c in columns], at.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to")))
    return both.select(F.inline(F.filter(F.array(kept, opened), lambda v: v.isNotNull())))


def scd2_merge(history: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str], as_of: str) -> DataFrame:
    """The whole history after a snapshot. Closed versions pass through untouched.

    Write it to a new path and switch readers over, or keep the table with
    ``sources.lake.write_history``, which rewrites the open versions and this snapshot's.
    """
    closed = history.where(F.col("valid_to").isNotNull())
    return closed.unionByName(scd2_step(open_versions(history), incoming, key, check_cols, as_of))


def as_of(history: DataFrame, date: str) -> DataFrame:
    """The versions valid at ``date`` (from inclusive, to exclusive)."""
    at = F.to_date(F.lit(date))
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
