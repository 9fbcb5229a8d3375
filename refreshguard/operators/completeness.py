"""NULL shares and counts, missing columns, codes without a value."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..context import Context
from ..functions.measures import Measure, count_of, flag, note, percent_of
from ..functions.ratios import quote
from ..functions.rules import missing_with
from .scan import ROWS, ScanChecks, run_scan

CATEGORY = "completeness"


def _nulls(checks: ScanChecks, column: str) -> str:
    return checks.count_if(f"null_{column}", f"{column} is null")


def _not_found(check: str, column: str, kind: str) -> Measure:
    return Measure(check, f"{column}_not_found", "0", "null", "0", "0", "'WARN'",
                   quote(f"{kind} column {column} not found in table"))


def _skipped_optional(column: str) -> Measure:
    return note("optional_fields", f"{column}_null_percentage", "SKIPPED", "WARN",
                f"Optional column {column} not found in table")


def required_checks(ctx: Context) -> ScanChecks:
    checks = ScanChecks(CATEGORY)
    for column in ctx.profile.required:
        if ctx.has(column):
            checks.add(percent_of(
                "required_fields", f"{column}_null_percentage", _nulls(checks, column), ROWS,
                "FAIL", f"records have a NULL {column} (required)"))
        else:
            checks.add(_not_found("required_fields", column, "Required"))
    return checks


def optional_checks(ctx: Context, report_missing: bool = False) -> ScanChecks:
    """Warn above the NULL threshold; an absent column is silent or SKIPPED."""
    checks = ScanChecks(CATEGORY)
    for column in ctx.profile.optional:
        if ctx.has(column):
            checks.add(percent_of(
                "optional_fields", f"{column}_null_percentage", _nulls(checks, column), ROWS,
                "WARN", f"records have a NULL {column} (optional)",
                limit=ctx.thresholds.null_percent))
        elif report_missing:
            checks.add(_skipped_optional(column))
    return checks


def code_type_checks(ctx: Context) -> ScanChecks:
    """Rows that give the type of a code but no code."""
    checks = ScanChecks(CATEGORY)
    if ctx.profile.code_with_type and ctx.has(*ctx.profile.code_with_type):
        code, kind = ctx.profile.code_with_type
        found = checks.count_if("code_missing", missing_with(code, kind))
        checks.add(count_of("procedure_code_type_consistency", "inconsistent_count", found,
                            ROWS, "WARN", f"records have NULL {code} but a {kind}"))
    return checks


def required_count_checks(ctx: Context) -> ScanChecks:
    """NULL counts of the required columns; INFO when there are no rows."""
    checks = ScanChecks(CATEGORY)
    for column in ctx.present(ctx.profile.required):
        found = _nulls(checks, column)
        status = f"if({ROWS} = 0, 'INFO', {flag(f'{found} > 0', 'FAIL')})"
        checks.add(count_of("required_fields", f"{column}_null_count", found, ROWS, None,
                            f"records have a NULL {column}", status=status))
    return checks


def missing_column_checks(ctx: Context) -> ScanChecks:
    """Only the rows about absent columns, required and optional."""
    checks = ScanChecks(CATEGORY)
    for column in ctx.profile.required:
        if not ctx.has(column):
            checks.add(_not_found("required_fields", column, "Required"))
    for column in ctx.profile.optional:
        if not ctx.has(column):
            checks.add(_skipped_optional(column))
    return checks


def family_checks(ctx: Context) -> list[ScanChecks]:
    return [required_checks(ctx), required_count_checks(ctx), optional_checks(ctx),
            code_type_checks(ctx)]


def completeness(ctx: Context) -> DataFrame:
    return run_scan(ctx, *family_checks(ctx))
