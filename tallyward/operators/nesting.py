"""Child rows into nested documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest(parent: DataFrame, children: Mapping[str, tuple[DataFrame, Sequence[str]]], key: str) -> DataFrame:
    """One document per parent row with an ordered array per child table.

    ``children`` maps the array name to ``(frame, item columns)``; a single column gives
    an array of its non-null values, several give an array of structs ordered by the
    first. Without children an array is empty. Every child table is read once, and all
    share one shuffle. A document holds all children of its parent, so the largest parent
    has to fit into one value.
    """
    pieces = [
        frame.where(F.col(key).isNotNull()).select(
            key, (F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)).alias(name))
        for name, (frame, columns) in children.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    arrays = rows.groupBy(key).agg(*[F.array_sort(F.collect_list(n)).alias(n) for n in children])
    out = parent.join(arrays, key, "left")
    return out.withColumns({n: F.coalesce(F.col(n), F.array().cast(out.schema[n].dataType)) for n in children})
