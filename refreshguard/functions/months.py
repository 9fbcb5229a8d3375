"""Refresh months as ``yyyy-MM`` labels and half-open date ranges."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_day(month: str) -> date:
    year, number = month.split("-")
    return date(int(year), int(number), 1)


def shift(month: str, steps: int) -> str:
    start = first_day(month)
    index = start.year * 12 + start.month - 1 + steps
    return f"{index // 12:04d}-{index % 12 + 1:02d}"


def months_between(start: str, end: str) -> int:
    """Number of months from ``start`` to ``end``, both counted."""
    a, b = first_day(start), first_day(end)
    return (b.year - a.year) * 12 + b.month - a.month + 1


def in_months(column: Column, start: str, end: str | None = None) -> Column:
    """A half-open range, so that the filter reaches the scan.

    Formatting the column to ``yyyy-MM`` and comparing would hide it from
    parquet row-group statistics and from partition pruning.
    """
    stop = first_day(shift(end or start, 1))
    return (column >= F.lit(first_day(start))) & (column < F.lit(stop))


def before_month_end(column: Column, month: str) -> Column:
    return column < F.lit(first_day(shift(month, 1)))


def month_start(column: Column) -> Column:
    return F.trunc(column, "MM")


def label(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM")
