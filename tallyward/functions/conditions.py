"""Rules written as one generated expression: labels, bands, classifiers, term lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def segment(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first true condition, else ``default``."""
    out = None
    for cond, value in cases:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def label(col, mapping: Mapping[str, object], default: object = None) -> Column:
    """Code to label (or sort position); an unknown code gives ``default``."""
    codes = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, _c(col)), F.lit(default))


def band(col, edges: Sequence[float], labels: Sequence[str], top: float | None = None,
         unknown: str = "Unknown") -> Column:
    """``labels[i]`` for values below ``edges[i]``, the last label above all edges.

    Null and values above ``top`` give ``unknown``; low values fall in the first band.
    """
    c = _c(col)
    bad = c.isNull() if top is None else c.isNull() | (c > top)
    cases = [(bad, unknown)] + [(c < edge, name) for edge, name in zip(edges, labels)]
    return segment(cases, labels[len(edges)])


def plausible(col, lo: float, hi: float) -> Column:
    """The value inside ``[lo, hi]``, else null."""
    c = _c(col)
    return F.when(c.between(lo, hi), c)


def due_within(date, as_of, months: int, active: Column | None = None) -> Column:
    """Is ``date`` between ``as_of`` and ``months`` months later (and ``active``)?"""
    start = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    inside = _c(date).between(start, F.add_months(start, months))
    return inside if active is None else active & inside


def classify(col, rules: Sequence[tuple[str, str]], default: str = "Other") -> Column:
    """Label of the first pattern found in the upper-cased text."""
    text = F.upper(_c(col))
    return segment([(text.rlike(pattern), name) for pattern, name in rules], default)


def matches_terms(col, exact: Sequence[str], contains: str | None = None) -> Column:
    """Is the lower-cased text one of ``exact`` or does it contain the ``contains`` pattern?"""
    text = F.lower(_c(col))
    hit = text.isin(list(exact))
    return hit if contains is None else hit | text.rlike(contains)


def matches(col, pattern) -> Column:
    """Regex test where the pattern is a column of the same row."""
    return F.rlike(_c(col), _c(pattern))
