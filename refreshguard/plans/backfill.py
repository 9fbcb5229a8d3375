"""The suite over a range of months in one job instead of a loop over months."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame

from ..context import Context
from ..functions.formats import to_results
from .suite import run_suite, suite_metrics


def over_months(ctx: Context, start: str, end: str) -> Context:
    """The same context over every month from ``start`` to ``end``."""
    if start > end:
        raise ValueError(f"{start} is after {end}")
    return ctx.with_(scope="range", start=start, month=end, previous=None)


def backfill_metrics(ctx: Context, start: str, end: str,
                     families: Iterable[str] = ("all",), keep: bool = False) -> DataFrame:
    """Metric rows of every month, each compared with the month before it.

    Every operator groups by month, so the events are read once per reduction
    for all months together, and a month without rows still gets its rows.
    ``keep`` writes the reductions first, as in ``suite_metrics``.
    """
    return suite_metrics(over_months(ctx, start, end), families, keep=keep)


def backfill_results(ctx: Context, start: str, end: str, run_id: str, run_start_time: datetime,
                     families: Iterable[str] = ("all",)) -> DataFrame:
    return to_results(backfill_metrics(ctx, start, end, families), run_id, run_start_time,
                      ctx.profile.name)


def run_backfill(ctx: Context, start: str, end: str, target: str, run_id: str,
                 run_start_time: datetime, families: Iterable[str] = ("all",),
                 fmt: str = "parquet", once: bool = False) -> dict[tuple[str, str], str]:
    """Write a backfill; months that fail leave ERROR rows and the others their own."""
    return run_suite([over_months(ctx, start, end)], target, run_id, run_start_time, families,
                     fmt=fmt, once=once)
