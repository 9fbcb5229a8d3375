"""Days of entities, marked once by the intervals that hold them.

For months that accumulate snapshots and reductions that are written.  Every day of an entity is a
row (``shared.entity_days``) and meets the disjoint intervals of its entity, so both sides are bounded by
the calendar however many events or snapshots the entity has.  Both dimensions mark the days in one
pass, and the events meet the marks in another, for all checks on intervals.

A mark is ``outside`` for a day that no enrollment holds, else a ``region`` (NULL if none holds the
day) with ``n`` events, once for each of its intervals.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import MONTH, Context
from . import snapshots
from .intervals import layers, merge

ENROLLED, REGIONS = "enroll", "geo"


def _held(spans: DataFrame) -> tuple[DataFrame, F.Column]:
    """Spans under other names, and whether one holds a day row and is known in its month."""
    spans = spans.withColumnRenamed("entity", "of_entity")
    return spans, ((F.col("entity") == F.col("of_entity")) & (F.col("day") >= F.col("first_day"))
                   & (F.col("day") <= F.col("last_day")) & (F.col("since") <= F.col(MONTH)))


def outside(days: DataFrame, intervals: DataFrame) -> DataFrame:
    """Days that no interval holds; an interval that comes again counts from its first month."""
    same = [c for c in intervals.columns if c != MONTH]
    first = intervals.groupBy(*same).agg(F.min(MONTH).alias("since"))
    spans, held = _held(merge(first, ["entity", "since"]))
    return days.join(spans, held, "left_anti").select(
        MONTH, "entity", "day", "n", F.lit(True).alias("outside"),
        F.lit(None).cast("string").alias("region"))


def placed(days: DataFrame, intervals: DataFrame) -> DataFrame:
    """Days by region, events once for each interval; days that none holds are in the NULL region."""
    spans, held = _held(layers(intervals.withColumnRenamed(MONTH, "since"),
                               ["entity", "since", "region"]))
    return (days.join(spans, held, "left").groupBy(MONTH, "entity", "day", "region")
            .agg(F.expr("sum(n * coalesce(times, 1L)) as n"))
            .select(MONTH, "entity", "day", "n", F.lit(False).alias("outside"),
                    F.col("region").cast("string").alias("region")))


def day_marks(ctx: Context, days: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """The marks of all days by the given dimensions."""
    made = {ENROLLED: lambda: outside(days, snapshots.enrollment(ctx)),
            REGIONS: lambda: placed(days, snapshots.regions(ctx))}
    return reduce(DataFrame.unionByName, [made[k]() for k in kinds])


def marked_ids(ctx: Context, marks: DataFrame) -> DataFrame:
    """Distinct event ids per month and region; those outside have the NULL region.

    An equi join on entity, day and month: an entity with a third of all rows is spread over its days.
    Events without an entity or a day are outside, so NULLs meet.
    """
    profile = ctx.profile
    events = ctx.events().select(
        MONTH, F.col(profile.entity).alias("entity"), F.to_date(profile.event_date).alias("day"),
        F.col(profile.event_id).alias("event_id")).alias("e")
    marks = marks.filter("outside or region is not null").select(
        MONTH, "entity", "day", "region").alias("m")
    same = (F.col("e.entity").eqNullSafe(F.col("m.entity")) & F.col("e.day").eqNullSafe(F.col("m.day"))
            & (F.col(f"e.{MONTH}") == F.col(f"m.{MONTH}")))
    # distinct() keeps a NULL event id, count_distinct() would not.
    return (events.join(marks, same).select(f"e.{MONTH}", "event_id", "region").distinct()
            .groupBy(MONTH, "region").agg(F.count("*").alias("n")))
