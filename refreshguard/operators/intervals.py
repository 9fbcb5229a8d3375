"""Events against validity intervals, without pairing them.

A range join compares every event of an entity with every interval of it, and
gathers both in one task.  Here both become rows on the entity's calendar,
summed per day before the shuffle, and one running total per entity answers
both questions:

* at an event day, the open intervals so far say how many cover the day;
* at an interval's first day and the day after its last, the events so far
  differ by exactly the events inside the interval.

What reaches one task per entity is bounded by the calendar, not by how many
events the entity has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..context import MONTH, Context
from ..functions import months

#: Months whose running totals are kept side by side.  Every event carries a total for each of them,
#: edges are repeated for each block: few months a block, as there are far more events than edges.
MONTHS = 16


def edge_days(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and day, by how many the number of open intervals changes.

    An interval opens on its first day and closes on the day after its last; a
    reversed one contains no day and is left out.
    """
    edges = intervals.filter("first_day <= last_day").selectExpr(
        *keys, "inline(array(named_struct('day', first_day, 'edge', 1), "
        "named_struct('day', date_add(last_day, 1), 'edge', -1)))")
    return edges.groupBy(*keys, "day").agg(F.sum("edge").alias("opened"))


def merge(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The same days as disjoint intervals, so that a day is in at most one per key."""
    line = W.partitionBy(*keys).orderBy("day")
    open_now = F.sum("opened").over(line.rowsBetween(W.unboundedPreceding, W.currentRow))
    turns = (edge_days(intervals, keys).filter("opened <> 0").withColumn("open", open_now)
             .filter("open = 0 or open = opened"))
    return (turns.withColumn("end", F.lead("day").over(line)).filter("open > 0")
            .selectExpr(*keys, "day as first_day", "date_sub(end, 1) as last_day"))


def layers(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The same days as disjoint intervals per key, with how many ``times`` each was given."""
    line = W.partitionBy(*keys).orderBy("day")
    open_now = F.sum("opened").over(line.rowsBetween(W.unboundedPreceding, W.currentRow))
    turns = (edge_days(intervals, keys).filter("opened <> 0").withColumn("times", open_now)
             .withColumn("end", F.lead("day").over(line)))
    return turns.filter("times > 0").selectExpr(
        *keys, "day as first_day", "date_sub(end, 1) as last_day", "times")


def calendar(ctx: Context, days: DataFrame, intervals: DataFrame) -> DataFrame:
    """Day rows with running totals.

    Columns: ``is_event``, ``n`` events and ``opened`` intervals of the row
    itself, ``events_before`` and ``covering`` as running totals, and the
    interval's ``region`` if it has one.
    """
    keys = [*ctx.by, "entity", "day"]
    region = ["region"] if "region" in intervals.columns else []
    events = days.selectExpr(*keys, *(f"cast(null as string) as {r}" for r in region),
                             "true as is_event", "n", "0L as opened")
    edges = edge_days(intervals, [*ctx.by, "entity", *region]).selectExpr(
        *keys, *region, "false as is_event", "0L as n", "opened")
    # Edges come before the events of their day: an interval covers its first
    # day and has ended on the day after its last.
    so_far = (W.partitionBy(*ctx.by, "entity").orderBy("day", "is_event")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (events.unionByName(edges)
            .withColumn("events_before", F.sum("n").over(so_far))
            .withColumn("covering", F.sum("opened").over(so_far)))


def _index(ctx: Context, column: str) -> str:
    """The place of a month in the range, from 0."""
    first = months.first_day(ctx.start)
    return f"(year({column}) * 12 + month({column}) - {first.year * 12 + first.month})"


def blocks(ctx: Context) -> list[Context]:
    """A range in parts of at most ``MONTHS`` months."""
    count = months.months_between(ctx.start, ctx.month)
    if count <= MONTHS:
        return [ctx]
    starts = [months.shift(ctx.start, k) for k in range(0, count, MONTHS)]
    ends = [*[months.shift(s, -1) for s in starts[1:]], ctx.month]
    return [ctx.with_(start=a, month=b) for a, b in zip(starts, ends)]


def accumulated(ctx: Context, days: DataFrame, intervals: DataFrame) -> DataFrame:
    """Day rows of all months of a range in which an interval counts from its own month on.

    One line per entity for all months: an event knows the place ``at`` of its
    month, an edge that of the first month which sees it.  Running totals are kept
    for each place by itself, as an array of differences; ``covering`` of an event
    is their sum up to its month.  ``before`` of an edge are the events so far, by
    month.  No row is repeated for the months that see it.
    """
    region = ["region"] if "region" in intervals.columns else []
    count = months.months_between(ctx.start, ctx.month)
    at = f"{_index(ctx, MONTH)} as at"
    events = days.selectExpr("entity", "day", *(f"cast(null as string) as {r}" for r in region),
                             "true as is_event", "n", "0L as opened", at)
    edges = edge_days(intervals, [MONTH, "entity", *region]).selectExpr(
        "entity", "day", *region, "false as is_event", "0L as n", "opened", at)
    so_far = (W.partitionBy("entity").orderBy("day", "is_event")
              .rowsBetween(W.unboundedPreceding, W.currentRow))

    def totals(value):
        return F.array(*[F.sum(F.expr(f"if(at = {k}, {value}, 0L)")).over(so_far)
                         for k in range(count)])

    found = events.unionByName(edges).withColumn("open", totals("opened"))
    if region:
        found = found.withColumn("before", totals("n"))
    return found.withColumn("covering", F.expr(
        "aggregate(slice(open, 1, at + 1), 0L, (total, x) -> total + x)")).drop("open")


def _of_blocks(ctx: Context, days: DataFrame, intervals: DataFrame, count) -> DataFrame:
    """``count`` of the day rows of each block, with the month again."""
    parts = []
    for part in blocks(ctx):
        first = F.lit(months.first_day(part.start))
        # With n > 0, which always holds, the filter stays above the reduction, which blocks can share.
        at = F.when(F.col("n") > 0, F.col(MONTH))
        own = days.filter((at >= first) & (at <= F.lit(months.first_day(part.month))))
        seen = (intervals.filter(F.col(MONTH) <= F.lit(months.first_day(part.month)))
                .withColumn(MONTH, F.greatest(MONTH, first)))
        rows = count(accumulated(part, own, seen))
        parts.append(rows.withColumn(MONTH, F.add_months(first, F.col("at").cast("int"))).drop("at"))
    return reduce(DataFrame.unionByName, parts)


def uncovered(ctx: Context, days: DataFrame, intervals: DataFrame) -> DataFrame:
    """``n`` events and ``n_outside`` of them that no interval contains."""
    sums = [F.expr("coalesce(sum(n), 0) as n"),
            F.expr("coalesce(sum(if(covering = 0, n, 0)), 0) as n_outside")]
    if ctx.accumulates:
        return ctx.complete(_of_blocks(
            ctx, days, intervals,
            lambda rows: rows.filter("is_event").groupBy("at").agg(*sums)).select(
                MONTH, "n", "n_outside"))
    found = calendar(ctx, days, intervals).filter("is_event")
    return ctx.complete(found.groupBy(*ctx.by).agg(*sums))


def region_counts(ctx: Context, days: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows a left join of the events with the intervals would give per region.

    An event in several intervals counts once for each; one in none counts for
    the NULL region.
    """
    if ctx.accumulates:
        # What an edge adds is told apart by month behind the window, in its own task.
        shares = ("inline(if(is_event, array(named_struct('at', at, 'm', if(covering = 0, n, 0L))), "
                  "transform(sequence(at, size(before) - 1), "
                  "k -> named_struct('at', k, 'm', -opened * before[k]))))")
        found = _of_blocks(ctx, days, intervals, lambda rows: (
            rows.selectExpr("region", shares).filter("m <> 0")
            .groupBy("at", "region").agg(F.sum("m").alias("n"))))
        return found.select(MONTH, "region", "n").filter("n > 0")
    rows = F.expr("sum(case when not is_event then -opened * events_before "
                  "when covering = 0 then n else 0 end) as n")
    return (calendar(ctx, days, intervals).groupBy(*ctx.by, "region").agg(rows)
            .filter("n > 0"))
