"""Column helpers: dates, text, numbers, conditions, arrays and keys."""

from .arrays import first_where, has, item_total
from .conditions import band, classify, due_within, label, matches, matches_terms, plausible, segment
from .dates import (
    calendar_columns,
    day,
    months_between_cal,
    partial_date,
    partial_iso_date,
    seconds_between,
    year_start,
)
from .keys import surrogate_key
from .numbers import cross_rate, ratio, safe_cast, safe_exp, safe_ln, safe_sqrt, scan_cost, to_kg, to_years
from .text import clean_name, contains_at, first_item, item_count, join_distinct, title, trim_all

__all__ = [
    "band", "calendar_columns", "classify", "clean_name", "contains_at", "cross_rate", "day",
    "due_within", "first_item", "first_where", "has", "item_count", "item_total", "join_distinct",
    "label", "matches", "matches_terms", "months_between_cal", "partial_date", "partial_iso_date",
    "plausible", "ratio", "safe_cast", "safe_exp", "safe_ln", "safe_sqrt", "scan_cost",
    "seconds_between", "segment", "surrogate_key", "title", "to_kg", "to_years", "trim_all",
    "year_start",
]
