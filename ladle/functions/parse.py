"""Parsing of messy text columns into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double_strict(col) -> Column:
    """Text to double only when the whole text is a plain number, else null.

    ``try_cast`` alone accepts '1d', 'nan' and 'inf'; the regex guard keeps
    those out.
    """
    c = _c(col)
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def parse_rating(col) -> Column:
    """'4.1/5' -> 4.1; anchored at the start after trimming; 'NEW', '-', null -> null."""
    c = _c(col)
    num = F.regexp_extract(F.trim(c), r"^([0-9.]+)\s*/\s*5", 1)
    return F.when(num != "", to_double_strict(num))


def parse_cost(col) -> Column:
    """'₹1,200' -> 1200.0; commas, rupee signs and spaces removed; bad -> null."""
    c = _c(col)
    return to_double_strict(F.regexp_replace(c, "[, ₹]", ""))


def parse_minutes(col) -> Column:
    """Keep digits and dots, then to double; empty -> null ('25 min' -> 25.0)."""
    c = _c(col)
    return to_double_strict(F.regexp_replace(c, r"[^0-9.]", ""))
