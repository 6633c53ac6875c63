"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text hashed in place of a null, needed for equal keys.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols, null_token: str = NULL_TOKEN) -> Column:
    """md5 of the columns as text; nulls keep their place through ``null_token``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
