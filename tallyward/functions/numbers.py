"""Arithmetic that yields null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_cast(col, dtype: str) -> Column:
    return _c(col).try_cast(dtype)


def ratio(num, den) -> Column:
    """``num / den`` as double; null when either is null or ``den`` is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def safe_ln(col) -> Column:
    c = _c(col)
    return F.when(c > 0, F.ln(c))


def safe_exp(col) -> Column:
    return F.exp(_c(col))


def safe_sqrt(col) -> Column:
    c = _c(col)
    return F.when(c >= 0, F.sqrt(c))


def to_years(value, unit) -> Column:
    """Age to years by unit code; an unknown unit gives null."""
    v, u = _c(value).cast("double"), _c(unit)
    return (
        F.when(u == "YR", v)
        .when(u == "MON", v / 12)
        .when(u == "WK", v / 52)
        .when(u == "DY", v / 365)
        .when(u == "HR", v / 8760)
        .when(u == "DEC", v * 10)
    )


def to_kg(value, unit) -> Column:
    """Weight to kilograms by unit code; an unknown unit gives null."""
    v, u = _c(value).cast("double"), _c(unit)
    return F.when(u == "KG", v).when(u == "LBS", v * 0.453592).when(u == "GMS", v / 1000)


def cross_rate(base, quote) -> Column:
    """Quote per base from two rates against a third currency; null unless both exist."""
    b, q = _c(base), _c(quote)
    return F.when(b.isNotNull() & q.isNotNull(), ratio(q, b))


def scan_cost(scanned_bytes, price_per_tib: float = 6.25) -> Column:
    return F.round(_c(scanned_bytes).cast("double") / float(2**40) * price_per_tib, 4)
