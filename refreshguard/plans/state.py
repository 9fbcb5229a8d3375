"""Month state: what comparisons need of a month, kept, so that a new month reads only its own events.

Two tables below a path, a folder for each month: ``entities`` has a row per
entity (its rows, and which roles it has), ``ids`` one per role and id (its entities).  A
month written again takes the place of what it was.  A comparison reads the state
of the months that it compares, already reduced; events of the previous month
are not touched, be it re-delivered, archived or gone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import OWN, Context
from ..functions import months
from ..operators import pairs
from ..operators.shared import SharedFrames
from . import suite

ENTITIES, IDS = "entities", "ids"


def _roles(ctx: Context) -> list[str]:
    return pairs.present_roles(ctx, pairs.ROLE_NAMES)


def _write(rows: DataFrame, path: str) -> None:
    """By month; the months that occur are replaced, the others stay."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(OWN).parquet(path))


def save(ctx: Context, path: str) -> None:
    """Write the state of the context's month, or of every month of its range, from their own events."""
    if ctx.scope == "all":
        raise ValueError("state is kept by month")
    if ctx.sample_rows:
        raise ValueError("state is kept of all rows")
    own = ctx.events().withColumn(OWN, months.month_start(F.col(ctx.profile.refresh_date)))
    roles = _roles(ctx)
    _write(pairs.entity_months(ctx, roles, own), f"{path}/{ENTITIES}")
    if roles:
        _write(pairs.id_months(ctx, roles, own), f"{path}/{IDS}")


class StateFrames(SharedFrames):
    """The reductions of a comparison, read from the state."""

    def __init__(self, ctx: Context, path: str):
        super().__init__(ctx, keep=True)
        self._path = path

    def _read(self, name: str) -> DataFrame:
        ctx = self._ctx
        rows = ctx.spark.read.parquet(f"{self._path}/{name}").withColumn(
            OWN, F.col(OWN).cast("date"))
        if ctx.scope == "range":
            return rows.filter(months.in_months(F.col(OWN), months.shift(ctx.start, -1), ctx.month))
        wanted = [months.first_day(m) for m in (ctx.month, ctx.previous) if m]
        return rows.filter(F.col(OWN).isin(wanted))

    def totals(self, roles: Sequence[str]) -> DataFrame:
        return pairs.entity_totals(self._ctx, roles, self._read(ENTITIES))

    def ids(self, roles: Sequence[str]) -> DataFrame:
        rows = self._read(IDS).filter(F.col("role").isin(list(roles)))
        return self._kept(pairs.role_ids(self._ctx, roles, rows=rows), "ids")


def compare(ctx: Context, path: str, families: Sequence[str] = suite.COMPARING) -> DataFrame:
    """Temporal and volume metrics of the context's months from their state."""
    families = [f for f in suite.COMPARING if f in families]
    parts = suite.comparison(ctx, families, StateFrames(ctx, path))
    return reduce(DataFrame.unionByName, parts)


def advance(ctx: Context, path: str) -> DataFrame:
    """Save a month and compare it with the one before."""
    save(ctx, path)
    return compare(ctx, path)
