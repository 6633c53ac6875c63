"""Whole-word search of many aliases in many texts, and search for parts of words.

``match_terms`` turns the theta join into one equi join: every text is exploded once, into its stretches of as many words
as the aliases have, and a stretch that equals an alias is a find. Aliases of many words are indexed by their rarest word
and its place, and verified where this word stands; one that starts or ends with a symbol is tested on the text itself, so
the result equals the regex form for every alias.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.text import literal_regex


def _runs(text: str | Column, word: str) -> Column:
    """The text cut into runs of word characters and runs of others, in turn."""
    return F.regexp_extract_all(text, F.lit(f"[{word}]+|[^{word}]+"), F.lit(0))


def boundary_pattern(alias: str, word: str = "A-Z0-9") -> str:
    """Regex for ``alias`` as a whole word: no word character next to it."""
    return f"(^|[^{word}]){literal_regex(alias)}([^{word}]|$)"


def boundary_pattern_column(alias, word: str = "A-Z0-9") -> Column:
    c = F.col(alias) if isinstance(alias, str) else alias
    quoted = F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit(f"(^|[^{word}])\\Q"), quoted, F.lit(f"\\E([^{word}]|$)"))


def _words(text: str | Column, word: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[{word}]+"), F.lit(0))


def _stretches(text: str | Column, word: str, n: int) -> Column:
    """Every stretch of ``n`` words in a row with what stands between them."""
    if n == 1:
        return _words(text, word)
    one = f"[{word}]++"
    rest = f"(?:[^{word}]++{one}){{{n - 1}}}"
    return F.regexp_extract_all(text, F.lit(f"(?<![{word}])(?=({one}{rest})){one}"), F.lit(1))


def _indexed(aliases: DataFrame, word: str, counts: DataFrame | None) -> DataFrame:
    """``(alias, product_id, whole, n, term, left)``: aliases by their rarest word.

    ``left`` counts an alias's words before ``term``. The rarest word has the smallest number in ``counts`` (term, seen);
    where it has none, the longest is taken for it.
    """
    names = ["alias", "product_id", "whole", "n"]
    places = aliases.select(*names, F.posexplode(_words("alias", word)).alias("left", "term"))
    if counts is None:
        places = places.withColumn("seen", F.lit(0))
    else:
        places = places.join(counts.select("term", "seen"), "term", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    rarest = F.min(F.struct("seen", (-F.length("term")).alias("short"), "term", "left")).alias("at")
    return places.groupBy(*names).agg(rarest).select(*names, "at.term", "at.left")


def word_counts(df: DataFrame, text: str, word: str = "A-Z0-9") -> DataFrame:
    """``(term, seen)``: every word of the upper-cased texts with its occurrences, for ``match_terms`` to choose by."""
    return df.select(F.explode(_words(F.upper(F.col(text)), word)).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("seen"))


# Aliases of up to so many words are looked up whole.
STRETCH = 4


def match_terms(df: DataFrame, key: str, text: str, aliases: DataFrame, word: str = "A-Z0-9",
                counts: DataFrame | None = None) -> DataFrame:
    """Rows ``(key, product_id, best_alias_length)`` for each alias found in ``text``.

    The text is upper-cased; aliases are upper case already. Aliases that begin and end with a word and have at most
    ``STRETCH`` of them are joined to the stretches of as many words of each text: what is equal is found, and only that
    is shuffled. ``df`` is read a second time only if there are other aliases (see ``_verified``). One row about the
    aliases is read first: which of these there are. ``counts`` (see ``word_counts``) tells which word of another alias
    is rarest.
    """
    names = aliases.where(F.col("alias") != "").select("alias", "product_id").distinct().select(
        "alias", "product_id", F.col("alias").rlike(rf"(?s)\A[{word}](.*[{word}])?\z").alias("whole"),
        F.size(_words("alias", word)).alias("n"))
    short = F.col("whole") & (F.col("n") <= STRETCH)
    there = names.agg(
        F.collect_set(F.when(short, F.col("n"))).alias("sizes"), F.bool_or(~short & (F.col("n") > 0)).alias("open"),
        F.bool_or(F.col("n") == 0).alias("bare")).first()
    texts = df.where(F.col(text).isNotNull()).select(F.col(key), F.upper(F.col(text)).alias("__text"))
    lists = [_stretches("__text", word, n) for n in sorted(there["sizes"])] or [F.array().cast("array<string>")]
    # A filter on the aliases would be tried on every stretch as well, as the two are equal; so others have a null here.
    index = names.select(F.when(short, F.col("alias")).alias("__stretch"), "alias", "product_id")
    kept = texts.select(key, F.explode(F.concat(*lists)).alias("__stretch")).join(index, "__stretch").select(
        key, "product_id", "alias")
    if there["open"] or there["bare"]:
        kept = kept.unionByName(_verified(texts, key, names.where(~short), word, counts, there["open"], there["bare"]))
    return longest_match(kept, [key, "product_id"], "alias")


def _verified(texts: DataFrame, key: str, names: DataFrame, word: str, counts: DataFrame | None, some_words: bool,
              bare: bool) -> DataFrame:
    """``(key, product_id, alias)`` found for aliases of many words, or with a symbol at an end, or without a word.

    What the rarest words of aliases (or the first sign of those without any, ``bare``) find is gathered by key, at most
    one entry per alias with the places, and verified on the texts of these keys only.
    """
    found = ["alias", "product_id", "whole", "n"]
    hits = []
    if some_words:
        words = texts.select(key, F.posexplode(_words("__text", word)).alias("place", "term"))
        start = F.when(F.col("whole"), F.col("place") - F.col("left")).alias("start")
        hits.append(words.join(_indexed(names.where("n > 0"), word, counts), "term").select(key, *found, start))
    if bare:
        sign = F.explode(F.array_distinct(F.regexp_extract_all("__text", F.lit(f"[^{word}]"), F.lit(0)))).alias("sign")
        first_sign = names.where("n = 0").withColumn("sign", F.substring("alias", 1, 1))
        hits.append(texts.select(key, sign).join(first_sign, "sign").select(
            key, *found, F.lit(None).cast("int").alias("start")))
    once = reduce(DataFrame.unionByName, hits).groupBy(key, *found).agg(F.collect_set("start").alias("starts"))
    by_key = once.groupBy(F.col(key).alias("__key")).agg(F.collect_list(F.struct(*found, "starts")).alias("__found"))
    placed = by_key.join(texts, F.col("__key").eqNullSafe(F.col(key))).withColumn("__runs", _runs("__text", word))
    first = F.when(F.get("__runs", F.lit(0)).rlike(f"^[{word}]"), 1).otherwise(2)

    def stands(alias: Column) -> Column:
        at = F.exists(alias["starts"], lambda i: (i >= 0) & (F.array_join(
            F.slice("__runs", 2 * i + first, 2 * alias["n"] - 1), "") == alias["alias"]))
        inside = F.rlike("__text", boundary_pattern_column(alias["alias"], word))
        return F.when(alias["whole"], at).otherwise(inside)

    return placed.select(F.col("__key").alias(key), F.inline(F.filter("__found", stands))).select(
        key, "product_id", "alias")


def match_terms_regex(df: DataFrame, key: str, text: str, aliases: Sequence[tuple[str, str]],
                      word: str = "A-Z0-9") -> DataFrame:
    """The same result from one regex per alias, for a short curated list."""
    upper = F.upper(F.col(text))
    tests = [
        F.when(upper.rlike(boundary_pattern(alias, word)),
               F.struct(F.lit(product).alias("product_id"), F.lit(alias).alias("alias")))
        for alias, product in aliases
    ]
    hits = F.filter(F.array(*tests), lambda x: x.isNotNull())
    found = df.where(F.col(text).isNotNull()).select(F.col(key), F.inline(hits))
    return longest_match(found, [key, "product_id"], "alias")


def longest_match(df: DataFrame, by: Sequence[str], text: str, name: str = "best_alias_length") -> DataFrame:
    """Length of the longest text per group."""
    return df.groupBy(*by).agg(F.max(F.length(text)).cast("bigint").alias(name))


def match_or_search(df: DataFrame, key: str, brand: str, text: str, aliases: DataFrame,
                    word: str = "A-Z") -> DataFrame:
    """Product by exact brand; only rows without one are searched by description.

    The longest alias wins, then the smaller product id. Here digits end a word.
    """
    exact = aliases.select(F.col("alias").alias("__brand"), F.col("product_id").alias("__exact"))
    keyed = df.join(exact, F.col(brand) == F.col("__brand"), "left").drop("__brand")
    hits = match_terms(keyed.where(F.col("__exact").isNull()), key, text, aliases, word)
    best = hits.groupBy(key).agg(
        F.min_by("product_id", F.struct(-F.col("best_alias_length"), F.col("product_id"))).alias("__found"))
    return (
        keyed.join(best, key, "left")
        .withColumn("product_id", F.coalesce("__exact", "__found"))
        .drop("__exact", "__found")
    )


GRAM = 3


def _grams(text: str, size: int = GRAM) -> Column:
    """Distinct stretches of ``size`` characters of a text."""
    n = F.length(text) - size + 1
    cut = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(n >= 1, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def exists_substring(df: DataFrame, terms: DataFrame, key: str, term: str, text: str,
                     name: str = "is_related") -> DataFrame:
    """Does any term of the row's key occur inside the row's text (ignoring case)?

    Each distinct key and text is known by the stretches of three characters in it, each term by the one of its
    stretches that is rarest among the texts; only a text and a term that share this one meet, and are then compared. A
    term with a stretch that no text holds meets none. Terms of one or two characters are known by themselves; an
    empty term is in every text. ``df`` is read twice: pass a table.
    """
    known = terms.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), F.lower(term).alias("__term")).where("__term IS NOT NULL").distinct()
    texts = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(
        "__key IS NOT NULL AND __text IS NOT NULL").distinct().withColumn("__lower", F.lower("__text"))
    sizes = known.agg(F.bool_or(F.length("__term") == 0).alias("empty"), F.bool_or(F.length("__term") == 1).alias("one"),
                      F.bool_or(F.length("__term") == 2).alias("two")).first()
    lists = [_grams("__lower")] + [_grams("__lower", n) for n, there in ((1, sizes["one"]), (2, sizes["two"])) if there]
    lists += [F.array(F.lit(""))] if sizes["empty"] else []
    # A text goes along as its hash; equal hashes only make more candidates, which are compared all the same.
    name_of = F.xxhash64("__lower").alias("__id")
    parts = texts.select("__key", name_of, F.explode(F.concat(*lists) if len(lists) > 1 else lists[0]).alias("__gram"))
    own = known.select("__key", "__term", F.explode(F.when(F.length("__term") < GRAM, F.array("__term")).otherwise(
        _grams("__term"))).alias("__gram"))
    counts = parts.join(own.select("__gram").distinct(), "__gram", "left_semi").groupBy("__gram").agg(
        F.count(F.lit(1)).alias("__n"))
    index = own.join(counts, "__gram", "left").withColumn("__n", F.coalesce("__n", F.lit(0))).groupBy("__key", "__term").agg(
        F.min(F.struct("__n", "__gram")).alias("__least")).where("__least.__n > 0").select(
        "__key", "__term", F.col("__least.__gram").alias("__gram"))
    met = parts.join(index, ["__key", "__gram"]).select("__key", "__id", "__term").distinct()
    hits = texts.withColumn("__id", name_of).join(met, ["__key", "__id"]).where(
        F.instr(F.col("__lower"), F.col("__term")) > 0).select("__key", "__text", F.lit(True).alias("__hit")).distinct()
    return (
        df.join(hits, (F.col(key) == F.col("__key")) & (F.col(text) == F.col("__text")), "left")
        .withColumn(name, F.coalesce("__hit", F.lit(False)))
        .drop("__key", "__text", "__hit")
    )
