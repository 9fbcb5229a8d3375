"""From one wide aggregate row to long-form metric rows.

A check is a list of ``Measure`` over the columns of an aggregate.  ``to_long``
turns the (single-row, or one-row-per-month) aggregate into metric rows inside
the same plan: statuses and texts are computed by Spark, not on the driver.
All expressions are SQL text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .ratios import change_percent, percent, quote, within

METRIC_COLUMNS = ("check_category", "check_name", "metric_name", "num", "den", "value",
                  "metric_value", "status", "details")
METRIC_SCHEMA = ("check_category string, check_name string, metric_name string, "
                 "num bigint, den bigint, value double, metric_value string, "
                 "status string, details string")


@dataclass(frozen=True)
class Measure:
    """One metric row.  ``metric`` is a name unless ``metric_sql`` is set.

    ``shown`` is the metric value as text, ``keep`` the condition under which
    the row exists.
    """

    check: str
    metric: str
    num: str = "null"
    den: str = "null"
    value: str = "null"
    shown: str = "null"
    status: str = "'INFO'"
    details: str = "null"
    keep: str | None = None
    metric_sql: str | None = None

    def as_struct(self, category: str) -> str:
        metric = self.metric_sql or quote(self.metric)
        row = (f"named_struct('check_category', {quote(category)}, "
               f"'check_name', {quote(self.check)}, 'metric_name', {metric}, "
               f"'num', cast({self.num} as bigint), 'den', cast({self.den} as bigint), "
               f"'value', cast({self.value} as double), "
               f"'metric_value', cast({self.shown} as string), "
               f"'status', {self.status}, 'details', cast({self.details} as string))")
        return row if self.keep is None else f"if({self.keep}, {row}, null)"


def flag(bad: str, severity: str) -> str:
    """``severity`` where ``bad`` holds, else PASS."""
    return f"if({bad}, {quote(severity)}, 'PASS')"


def counted(num: str, den: str, text: str) -> str:
    return f"concat(string({num}), ' of ', string({den}), {quote(' ' + text)})"


def percent_of(check: str, metric: str, num: str, den: str, severity: str, text: str,
               limit: float = 0.0, below: bool = False, keep: str | None = None,
               status: str | None = None) -> Measure:
    """A percentage that turns to ``severity`` above (or below) ``limit``."""
    value = percent(num, den)
    if status is None:
        status = flag(f"{value} {'<' if below else '>'} {limit}D", severity)
    return Measure(check, metric, num, den, value, value, status, counted(num, den, text), keep)


def count_of(check: str, metric: str, num: str, den: str | None, severity: str | None, text: str,
             keep: str | None = None, status: str | None = None) -> Measure:
    """A count; with a ``severity`` any value above 0 raises it."""
    if status is None:
        status = "'INFO'" if severity is None else flag(f"{num} > 0", severity)
    details = quote(text) if den is None else counted(num, den, text)
    return Measure(check, metric, num, den or "null", num, num, status, details, keep)


def compared(check: str, metric: str, current: str, previous: str) -> Measure:
    """A current count with the previous month's count beside it."""
    return Measure(check, metric, current, previous, current, current, "'INFO'",
                   f"concat('Previous month: ', string({previous}))")


def change(check: str, metric: str, current: str, previous: str, threshold: float,
           what: str, counts: bool = True) -> Measure:
    """Month-over-month change; N/A when the previous month had none."""
    moved = change_percent(current, previous)
    limit = f"{threshold * 100:.0f}"
    return Measure(
        check, metric, current if counts else "null", previous if counts else "null", moved,
        f"coalesce(string({moved}), 'N/A')",
        f"case when {moved} is null then 'INFO' when {within(moved, threshold)} then 'PASS' "
        "else 'WARN' end",
        f"if({moved} is null, {quote(f'no {what} in the month before')}, "
        f"format_string('moved by %+.2f%%, {limit}%% either way pass', {moved}))")


def note(check: str, metric: str, text: str, status: str, details: str,
         keep: str | None = None) -> Measure:
    """A row that carries a word (SKIPPED, EMPTY, ...) instead of a number."""
    return Measure(check, metric, shown=quote(text), status=quote(status),
                   details=quote(details), keep=keep)


def to_long(wide: DataFrame, by: Sequence[str], category: str,
            measures: Iterable[Measure]) -> DataFrame:
    return rows_of(wide, by, [m.as_struct(category) for m in measures])


def rows_of(wide: DataFrame, by: Sequence[str], structs: Sequence[str]) -> DataFrame:
    """One row per struct that is not NULL."""
    return wide.selectExpr(*by, f"inline(array_compact(array({', '.join(structs)})))")
