"""Reductions of the events that several checks start from.

A suite builds each of them once.  Spark recognises the equal subplans and
reuses the shuffle, so the events are scanned once per reduction, not once per
check.  (An inner join or an unused column would change the subplan; the checks
therefore join ``left`` and read every column of a reduction.)
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import MONTH, Context
from ..sources.shared import stored
from . import marks, pairs


def entity_days(ctx: Context) -> DataFrame:
    """Events per entity and day: at most one row per calendar day of an entity."""
    profile = ctx.profile
    return (ctx.events().select(*ctx.by, F.col(profile.entity).alias("entity"),
                                F.to_date(profile.event_date).alias("day"))
            .groupBy(*ctx.by, "entity", "day").agg(F.count("*").alias("n")))


def provider_ids(ctx: Context) -> DataFrame:
    """Ids of all provider columns with their events per column, in one pass."""
    columns = ctx.present(ctx.profile.id_columns)
    pairs = F.array(*[F.struct(F.lit(k).alias("place"), F.col(c).alias("id"))
                      for k, c in enumerate(columns)])
    return (ctx.events().select(*ctx.by, F.inline(pairs)).filter(F.col("id").isNotNull())
            .groupBy(*ctx.by, "id")
            .agg(*[F.expr(f"count_if(place = {k}) as n_{c}") for k, c in enumerate(columns)]))


class SharedFrames:
    """The reductions of one context, each built when first asked for.

    With ``keep`` a reduction is computed once, written to the shared folder and
    read from there: the plans of the checks are small and start from small
    tables, and the events are scanned once per reduction whatever the number
    of checks and however Spark plans them.
    """

    def __init__(self, ctx: Context, keep: bool = False, together: Sequence[str] = ()):
        self._ctx = ctx
        self._keep = keep
        # Dimensions whose marks are written in one pass; a failure of one is one of all of them.
        self._together = tuple(together)
        self._marks: dict[tuple[str, ...], DataFrame] = {}
        self._marked: dict[tuple[str, ...], DataFrame] = {}

    @property
    def lazy(self) -> bool:
        """Whether reductions are parts of a plan still."""
        return not self._keep

    def _kept(self, frame: DataFrame, name: str) -> DataFrame:
        return stored(frame, name) if self._keep else frame

    @cached_property
    def days(self) -> DataFrame:
        return self._kept(entity_days(self._ctx), "days")

    @cached_property
    def providers(self) -> DataFrame:
        return self._kept(provider_ids(self._ctx), "providers")

    @cached_property
    def entities(self) -> DataFrame:
        """Events per entity."""
        return (self.days.groupBy(*self._ctx.by, "entity")
                .agg(F.sum("n").alias("n_events")))

    @property
    def marks_days(self) -> bool:
        """Whether days are marked by their intervals, and the marks written."""
        return self._keep and self._ctx.accumulates

    def _kinds(self, kind: str) -> tuple[str, ...]:
        return self._together if kind in self._together else (kind,)

    def marks(self, kind: str) -> DataFrame:
        """``marks.day_marks`` by one dimension."""
        kinds = self._kinds(kind)
        if kinds not in self._marks:
            self._marks[kinds] = self._kept(marks.day_marks(self._ctx, self.days, kinds), "marks")
        return self._marks[kinds].filter("outside" if kind == marks.ENROLLED else "not outside")

    def marked_ids(self, kind: str) -> DataFrame:
        """``marks.marked_ids`` by one dimension."""
        kinds = self._kinds(kind)
        if kinds not in self._marked:
            self.marks(kind)
            self._marked[kinds] = self._kept(
                marks.marked_ids(self._ctx, self._marks[kinds]), "marked")
        return self._marked[kinds].filter(
            "region is null" if kind == marks.ENROLLED else "region is not null")

    def uncovered(self) -> DataFrame:
        """``intervals.uncovered`` by enrollment, from the marks."""
        both = self.days.selectExpr(MONTH, "n", "0L as n_outside").unionByName(
            self.marks(marks.ENROLLED).selectExpr(MONTH, "0L as n", "n as n_outside"))
        return self._ctx.complete(both.groupBy(MONTH).agg(
            F.sum("n").alias("n"), F.sum("n_outside").alias("n_outside")))

    def region_counts(self) -> DataFrame:
        """``intervals.region_counts``, from the marks."""
        return self.marks(marks.REGIONS).groupBy(MONTH, "region").agg(F.sum("n").alias("n"))

    def totals(self, roles: Sequence[str]) -> DataFrame:
        """``pairs.entity_totals`` of the compared months."""
        return self._kept(pairs.entity_totals(self._ctx, roles), "totals")

    def ids(self, roles: Sequence[str]) -> DataFrame:
        """``pairs.role_ids`` of the compared months."""
        return self._kept(pairs.role_ids(self._ctx, roles), "ids")
