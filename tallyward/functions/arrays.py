"""Nested values: first match, membership, length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_where(array, cond: Callable[[Column], Column]) -> Column:
    """First element that satisfies ``cond``, else null."""
    return F.get(F.filter(_c(array), cond), F.lit(0))


def has(array, value) -> Column:
    """Membership; a missing array or null elements never give null."""
    return F.coalesce(F.array_contains(_c(array), value), F.lit(False))


def item_total(array) -> Column:
    """Array length; a missing array counts 0."""
    a = _c(array)
    return F.when(a.isNull(), F.lit(0)).otherwise(F.size(a)).cast("bigint")
