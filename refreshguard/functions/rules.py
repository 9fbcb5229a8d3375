"""Violation predicates as SQL.  Each is NULL-safe: a NULL value never violates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from .ratios import quote


def after_date(column: str, day: date) -> str:
    return f"{column} > date'{day}'"


def before_year(column: str, year: int) -> str:
    return f"year({column}) < {year}"


def wrong_length(column: str, length: int, ignore: str = "-") -> str:
    return f"length(replace({column}, {quote(ignore)}, '')) <> {length}"


def not_digits(column: str, length: int) -> str:
    return f"length({column}) <> {length} or {column} rlike '[^0-9]'"


def not_allowed(column: str, values: Iterable[str], fold_values: bool = True) -> str:
    """Upper-cased value outside the list.

    With ``fold_values`` the list is upper-cased too, so a mixed-case entry can
    match; without it such an entry never does.
    """
    listed = ", ".join(quote(v.upper() if fold_values else v) for v in values)
    return f"upper({column}) not in ({listed})"


def not_positive(column: str) -> str:
    return f"{column} <= 0"


def above(column: str, limit: float) -> str:
    return f"{column} > {limit}"


def earlier_than(first: str, second: str) -> str:
    return f"{first} < {second}"


def missing_with(column: str, partner: str) -> str:
    return f"{column} is null and {partner} is not null"
