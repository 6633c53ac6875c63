"""Attribute rows to products through an alias table (one row per alias)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_names(df: DataFrame, aliases: DataFrame, name_key: str, ingr_key: str,
                keep_unmatched: bool = False) -> DataFrame:
    """Product, match method and the alias's owner rule: by name, else by ingredient.

    Null keys never match. ``aliases`` has ``alias``, ``product_id``, ``requires_owner``.
    """
    def side(key: str, tag: str) -> DataFrame:
        return aliases.select(
            F.col("alias").alias(key), F.col("product_id").alias(f"__p_{tag}"),
            F.col("requires_owner").alias(f"__r_{tag}"))

    out = (
        df.join(side("__name", "name"), F.col("__name") == F.col(name_key), "left")
        .join(side("__ingr", "ingr"), F.col("__ingr") == F.col(ingr_key), "left")
        .withColumns({
            "product_id": F.coalesce("__p_name", "__p_ingr"),
            "match_method": F.when(F.col("__p_name").isNotNull(), "drug name")
            .when(F.col("__p_ingr").isNotNull(), "active ingredient"),
            "requires_owner": F.coalesce("__r_name", "__r_ingr")})
        .drop("__name", "__p_name", "__r_name", "__ingr", "__p_ingr", "__r_ingr")
    )
    return out if keep_unmatched else out.where(F.col("product_id").isNotNull())


def attribute(df: DataFrame, aliases: DataFrame, name_key: str, ingr_key: str,
              owner_col: str | None = None, keep_unmatched: bool = False) -> DataFrame:
    """``match_names`` with the owner rule applied.

    With ``owner_col`` an alias marked ``requires_owner`` counts only where that flag is
    true; without it the mark is ignored.
    """
    out = match_names(df, aliases, name_key, ingr_key, keep_unmatched)
    if owner_col:
        allowed = F.coalesce(~F.col("requires_owner") | F.col(owner_col), F.lit(False))
        if keep_unmatched:
            out = out.withColumns({c: F.when(allowed, F.col(c)) for c in ("product_id", "match_method")})
        else:
            out = out.where(allowed)
    return out.drop("requires_owner")


def attribute_exact(df: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """Rows whose key equals an alias, with the product."""
    side = aliases.select(F.col("alias").alias("__alias"), "product_id")
    return df.join(side, F.col(key) == F.col("__alias"), "inner").drop("__alias")
