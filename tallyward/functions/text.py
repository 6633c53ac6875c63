"""Text cleaning and delimited lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def literal_regex(text: str) -> str:
    """A regular expression that matches ``text`` itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# The Unicode white space characters.
WHITESPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trim_all(col) -> Column:
    """Trim every kind of whitespace (Spark's ``trim`` removes blanks only)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def clean_name(col) -> Column:
    """Upper-case key of a name: trailing dots and outer whitespace dropped, empty to null.

    Dots go only from the very end (before trailing whitespace), as one block.
    """
    no_dots = F.rtrim(F.rtrim(_c(col), F.lit(WHITESPACE)), F.lit("."))
    return F.nullif(F.upper(trim_all(no_dots)), F.lit(""))


def title(col) -> Column:
    """Trimmed term in lower case with a capital after everything that is no letter, digit or mark."""
    # A bell stands before each word, so that one split finds the word starts; it is no part of a term.
    words = F.split(F.regexp_replace(F.lower(trim_all(col)), r"(?<![\p{L}\p{N}\p{M}])(?=[\p{L}])", "\x07"), "\x07")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(
        w, 2, 1 << 30))), "")


def first_item(col, sep: str = "|") -> Column:
    return F.get(F.split(_c(col), literal_regex(sep)), F.lit(0))


def item_count(col, sep: str = "|") -> Column:
    parts = F.split(F.nullif(_c(col), F.lit("")), literal_regex(sep))
    return F.coalesce(F.size(parts), F.lit(0)).cast("bigint")


def join_distinct(array, sep: str = "|") -> Column:
    """Items in first-seen order without blanks or repeats, joined; no items give null."""
    # Nulls are left out by the join.
    kept = F.array_distinct(F.array_remove(_c(array), ""))
    return F.nullif(F.array_join(kept, sep), F.lit(""))


def contains_at(col, term) -> Column:
    """1-based position of ``term`` in ``col``; 0 when absent."""
    return F.instr(_c(col), _c(term)).cast("bigint")
