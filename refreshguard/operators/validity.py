"""Dates, formats, allow-lists and quantities, all in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..context import Context
from ..functions import rules
from ..functions.measures import count_of, note, percent_of
from .scan import ROWS, ScanChecks, run_scan

CATEGORY = "validity"


def _rule(checks: ScanChecks, check: str, metric: str, condition: str, severity: str,
          text: str) -> None:
    """Two rows from one count: the share of all rows, and the count itself."""
    found = checks.count_if(metric, condition)
    some = f"{ROWS} > 0"
    checks.add(percent_of(check, metric, found, ROWS, severity, text, keep=some))
    checks.add(count_of(check, metric.replace("_percent", "_count"), found, ROWS, severity,
                        text, keep=some))


def rule_set(ctx: Context, only: Sequence[str] | None = None) -> ScanChecks:
    """Every rule whose columns exist; ``only`` selects rules by check name."""
    checks = ScanChecks(CATEGORY)
    profile, limits = ctx.profile, ctx.thresholds

    def rule(check, metric, column, condition, severity, text):
        if column is None or not ctx.has(column) or (only and check not in only):
            return
        _rule(checks, check, metric, condition(column), severity, f"records have {text}")

    day = profile.event_date
    if not ctx.has(day):
        for check in ("future_dates", "old_dates"):
            if not only or check in only:
                checks.add(note(check, "status", "SKIPPED", "WARN", f"Column {day} not found"))
    rule("future_dates", "future_date_percent", day,
         lambda c: rules.after_date(c, ctx.as_of), "FAIL", f"{day} in the future")
    rule("old_dates", "old_date_percent", day,
         lambda c: rules.before_year(c, limits.old_year), "WARN",
         f"{day} before {limits.old_year}")
    rule("ndc_format", "invalid_ndc_percent", profile.drug_code,
         lambda c: rules.wrong_length(c, limits.code_length), "WARN",
         f"{profile.drug_code} not of {limits.code_length} characters, hyphens ignored")
    for column, (check, metric, values) in profile.allowed.items():
        rule(check, metric, column,
             lambda c, v=values: rules.not_allowed(c, v, ctx.fold_allowed), "WARN",
             f"unexpected {column}. Expected: {', '.join(values)}")
    for column, (prefix, stem) in profile.quantities.items():
        rule(f"{prefix}_positive", f"negative_{stem}_percent", column, rules.not_positive,
             "FAIL", f"non-positive {column}")
        if column in profile.capped:
            rule(f"{prefix}_extreme", f"extreme_{stem}_percent", column,
                 lambda c: rules.above(c, limits.extreme_quantity), "WARN",
                 f"{column} > {limits.extreme_quantity:g}")
    for column in profile.id_columns:
        rule(f"{column}_format", f"invalid_{column}_percent", column,
             lambda c: rules.not_digits(c, limits.id_length), "WARN",
             f"{column} not of {limits.id_length} digits")
    if ctx.has(day, profile.written_date):
        rule("fill_date_order", "invalid_order_percent", day,
             lambda c: rules.earlier_than(c, profile.written_date), "WARN",
             f"{day} before {profile.written_date}")
    rule(f"future_{profile.end_date}", f"future_{profile.end_date}_percent", profile.end_date,
         lambda c: rules.after_date(c, ctx.as_of), "FAIL", f"{profile.end_date} in the future")
    if not only:
        checks.add(_empty_row())
    return checks


def _empty_row():
    return note("overall_validity", "status", "SKIPPED", "INFO", "No events to validate.",
                keep=f"{ROWS} = 0")


def validity(ctx: Context, only: Sequence[str] | None = None) -> DataFrame:
    """The whole family, or the named checks, from one aggregation."""
    return run_scan(ctx, rule_set(ctx, only))


def validity_empty(ctx: Context) -> DataFrame:
    """Only the row that says there was nothing to validate."""
    checks = ScanChecks(CATEGORY)
    checks.add(_empty_row())
    return run_scan(ctx, checks)
