"""Snapshot dimensions: known keys, latest rows, intervals, ages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import MONTH, Context


def latest_per_key(table: DataFrame, keys: list[str], order: str, *payload: str) -> DataFrame:
    """The row with the greatest ``order`` of each key.

    ``max`` over a struct is combined map-side, so a key with very many
    snapshots does not gather in one task the way a ``row_number`` window over
    all of them would.  Ties go to the greatest payload: the result does not
    depend on row order.
    """
    newest = F.max(F.struct(order, *payload)).alias("newest")
    return table.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def mark_known(ctx: Context, ids: DataFrame, name: str, key: str, column: str) -> DataFrame:
    """Add ``known``: does a visible snapshot of the dimension have the id?

    Each key of the dimension meets the ids once.  Over months that accumulate
    snapshots a key is known from its first month on, so nothing is repeated
    per month.  A NULL id is never known.
    """
    keys = (ctx.dimension(name, key).filter(F.col(key).isNotNull())
            .withColumnRenamed(key, column))
    if ctx.accumulates:
        since = keys.groupBy(column).agg(F.min(MONTH).alias("since"))
        return (ids.join(since, column, "left")
                .withColumn("known", F.coalesce(F.col("since") <= F.col(MONTH), F.lit(False)))
                .drop("since"))
    seen = keys.select(*ctx.by, column).distinct().withColumn("seen", F.lit(True))
    return (ids.join(seen, [*ctx.by, column], "left")
            .withColumn("known", F.coalesce("seen", F.lit(False))).drop("seen"))


def attach_latest(ctx: Context, rows: DataFrame, table: DataFrame, *payload: str) -> DataFrame:
    """Add the latest visible snapshot of each row's ``entity`` as ``latest``.

    ``table`` comes from ``Context.dimension`` with an ``entity`` column.  Over
    months that accumulate snapshots this is an as-of join: rows and snapshots
    lie on one time line per entity and each row takes the last snapshot before
    it.  Snapshots are reduced to one per entity and month first.
    """
    refresh = ctx.names.refresh_date
    table = table.filter("entity is not null")
    latest = (table.groupBy(*ctx.by, "entity")
              .agg(F.max(F.struct(refresh, *payload)).alias("latest")))
    if not ctx.accumulates:
        return rows.join(latest, [*ctx.by, "entity"], "left")
    others = [c for c in rows.columns if c not in (MONTH, "entity")]
    both = (rows.withColumn("latest", F.lit(None).cast(latest.schema["latest"].dataType))
            .withColumn("is_row", F.lit(True))
            .unionByName(latest.withColumn("is_row", F.lit(False)), allowMissingColumns=True))
    so_far = (W.partitionBy("entity").orderBy(MONTH, "is_row")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (both.withColumn("latest", F.last("latest", ignorenulls=True).over(so_far))
            .filter("is_row").select(MONTH, "entity", *others, "latest"))


def birth_year(table: DataFrame, column: str) -> Column:
    """The year of birth from an integer year or from a date."""
    if isinstance(table.schema[column].dataType, T.IntegralType):
        return F.col(column)
    return F.year(F.to_date(column))


def age_group(age: Column) -> Column:
    return (F.when(age < 18, "0-17").when(age < 45, "18-44").when(age < 65, "45-64")
            .when(age >= 65, "65+").otherwise("Unknown"))


# The groups above, the open one last.
AGE_GROUPS = ("0-17", "18-44", "45-64", "65+", "Unknown")


def with_demographics(ctx: Context, rows: DataFrame, as_of: date | None = None) -> DataFrame:
    """Add ``linked``, ``gender`` and ``age_group`` to rows with an ``entity``."""
    n = ctx.names
    table = ctx.dimension("demo", n.entity, n.gender, n.birth).withColumnRenamed(
        n.entity, "entity")
    table = table.withColumn("birth", birth_year(table, n.birth)).withColumn(
        "gender", F.upper(n.gender))
    age = F.lit((as_of or ctx.as_of).year) - F.col("latest.birth")
    return (attach_latest(ctx, rows, table, "gender", "birth")
            .withColumn("linked", F.col("latest").isNotNull())
            .withColumn("gender", F.col("latest.gender"))
            .withColumn("age_group", F.when(F.col("linked"), age_group(age))))


def with_death(ctx: Context, days: DataFrame) -> DataFrame:
    """Add the latest known ``death`` date to day rows of entities.

    Over months that accumulate snapshots a death counts from its own month to that of the next one.
    Days look theirs up, as the deceased are few beside them; days without one are left out.
    """
    n = ctx.names
    table = (ctx.dimension("mortality", n.entity, n.death_date)
             .withColumnRenamed(n.entity, "entity")
             .withColumn("death", F.to_date(n.death_date)).filter("death is not null"))
    if not ctx.accumulates:
        return attach_latest(ctx, days, table, "death").withColumn("death", F.col("latest.death"))
    until = F.lead(MONTH).over(W.partitionBy("entity").orderBy(MONTH))
    known = (table.filter("entity is not null").groupBy(MONTH, "entity")
             .agg(F.max(F.struct(n.refresh_date, "death")).alias("latest"))
             .select(F.col("entity").alias("of_entity"), F.col(MONTH).alias("since"),
                     until.alias("until"), F.col("latest.death").alias("death")))
    # n > 0 always holds; with it the reduction is the same subplan as elsewhere.
    entity = F.when(F.col("n") > 0, F.col("entity"))
    then = ((F.col(MONTH) >= F.col("since"))
            & (F.col("until").isNull() | (F.col(MONTH) < F.col("until"))))
    return days.join(known, (entity == F.col("of_entity")) & then).select(
        *days.columns, "death")


def enrollment(ctx: Context) -> DataFrame:
    n = ctx.names
    return _intervals(ctx, "enroll", n.enroll_start, n.enroll_end)


def regions(ctx: Context) -> DataFrame:
    n = ctx.names
    return _intervals(ctx, "geo", n.region_from, n.region_to, n.region)


def _intervals(ctx: Context, name: str, first: str, last: str,
               region: str | None = None) -> DataFrame:
    """Complete intervals: ``entity``, ``first_day``, ``last_day``, ``region``."""
    n = ctx.names
    extra = [region] if region else []
    columns = ["entity", "first_day", "last_day", *(["region"] if region else [])]
    return ctx.dimension(name, n.entity, first, last, *extra).select(
        *ctx.by, F.col(n.entity).alias("entity"), F.to_date(first).alias("first_day"),
        F.to_date(last).alias("last_day"),
        *[F.col(c).alias("region") for c in extra]).dropna(subset=columns)
