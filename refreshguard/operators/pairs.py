"""The two reductions behind every month-over-month metric.

``entity_totals`` has one row per entity on the way (rows, months, roles);
``role_ids`` one row per (role, id) with the entities behind it in both months.
A single aggregation with a ``count_distinct`` per metric would instead copy
every event once per distinct expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import OWN, Context

DRUG = "drug"
ROLE_NAMES = ("code", "provider", "organization", "payer", "cohort", DRUG)
COUNTED_BY_ENTITY = ("provider", "organization", "cohort", DRUG)


def role_column(ctx: Context, role: str) -> str | None:
    return ctx.profile.drug_code if role == DRUG else ctx.profile.roles.get(role)


def present_roles(ctx: Context, wanted: Sequence[str]) -> list[str]:
    return [r for r in wanted if ctx.has(role_column(ctx, r))]


def entity_months(ctx: Context, roles: Sequence[str], events: DataFrame) -> DataFrame:
    """Per month and entity its rows and whether it has each role."""
    return (events.withColumn("entity", F.col(ctx.profile.entity)).groupBy(OWN, "entity").agg(
        F.count("*").alias("n"),
        *[F.expr(f"max({role_column(ctx, r)} is not null) as has_{r}") for r in roles]))


def entity_totals(ctx: Context, roles: Sequence[str] = (),
                  rows: DataFrame | None = None) -> DataFrame:
    """One wide row: what both months have, from one ``groupBy(entity)``.

    ``rows`` are those of ``entity_months`` for the compared months, if there are such.

    Rows, entities, entities with each role, and entities that are in both
    months or only in the current one.  Columns ending in ``_any`` count the
    NULL entity as one that was never seen before; the others ignore it.
    """
    number = "count_if({0})" if rows is None else "sum(if({0}, n, 0))"
    per_entity = [f"{number.format('in_cur')} as rows_cur",
                  f"{number.format('in_prev')} as rows_prev", "max(in_cur) as cur", "max(in_prev) as prev"]
    known = "entity is not null"
    wide = ["coalesce(sum(rows_cur), 0) as records_cur",
            "coalesce(sum(rows_prev), 0) as records_prev",
            f"count_if(cur and {known}) as entities_cur",
            f"count_if(prev and {known}) as entities_prev",
            f"count_if(cur and prev and {known}) as both",
            f"count_if(cur and not prev and {known}) as new",
            "count_if(cur) as cur_any", "count_if(prev) as prev_any",
            f"count_if(cur and (not prev or not {known})) as new_any"]
    for role in roles:
        for month in ("cur", "prev"):
            name = f"{role}_entities_{month}"
            has = f"{role_column(ctx, role)} is not null" if rows is None else f"has_{role}"
            per_entity.append(f"max(in_{month} and {has}) as {name}")
            wide.append(f"count_if({name} and {known}) as {name}")
    paired = (ctx.paired().withColumn("entity", F.col(ctx.profile.entity)) if rows is None
              else ctx.pair(rows))
    seen = (paired.groupBy(*ctx.by, "entity").agg(*[F.expr(e) for e in per_entity]))
    return ctx.complete(seen.groupBy(*ctx.by).agg(*[F.expr(e) for e in wide]))


def triples(ctx: Context, roles: Sequence[str], events: DataFrame,
            by_entity: Sequence[str] = COUNTED_BY_ENTITY) -> DataFrame:
    """Distinct (month, role, id, entity); roles outside ``by_entity`` have no entity.

    A role is its place in ``ROLE_NAMES``: these are the widest rows of all, and the most.
    """
    entity = ctx.profile.entity
    items = ", ".join(
        f"named_struct('role', {ROLE_NAMES.index(r)}Y, 'id', cast({role_column(ctx, r)} as string), 'entity', "
        f"{entity if r in by_entity else f'if(false, {entity}, null)'})" for r in roles)
    return (events.selectExpr(OWN, f"inline(array({items}))").filter("id is not null").distinct())


def id_months(ctx: Context, roles: Sequence[str], events: DataFrame,
              by_entity: Sequence[str] = COUNTED_BY_ENTITY) -> DataFrame:
    """Per month, role and id its distinct entities.

    Roles outside ``by_entity`` are only counted, so their entity is dropped
    before the shuffle.  Distinct (month, role, id, entity) rows spread a
    dominant id over all tasks; the second level sums what is left map-side.
    """
    names = " ".join(f"when {ROLE_NAMES.index(r)}Y then '{r}'" for r in roles)
    return (triples(ctx, roles, events, by_entity).groupBy(OWN, "role", "id")
            .agg(F.count("entity").alias("entities"))
            .selectExpr(OWN, f"case role {names} end as role", "id", "entities"))


def role_ids(ctx: Context, roles: Sequence[str],
             by_entity: Sequence[str] = COUNTED_BY_ENTITY,
             rows: DataFrame | None = None) -> DataFrame:
    """Ids per role: in which months they occur and how many entities they have.

    Each month is counted by itself; only its counts stand beside those of the
    month after, so what is paired has a row per id and month, not per entity.

    ``role_no`` repeats the role as an aggregate: a filter on it stays above
    the shuffle, which several users can then share.  ``rows`` are those of ``id_months`` for the
    compared months, if there are such.
    """
    rows = id_months(ctx, roles, ctx.compared(), by_entity) if rows is None else rows
    numbers = " ".join(f"when '{r}' then {ROLE_NAMES.index(r)}" for r in roles)
    return ctx.pair(rows).groupBy(*ctx.by, "role", "id").agg(*[F.expr(e) for e in (
        "max(in_cur) as in_cur", "max(in_prev) as in_prev",
        "sum(if(in_cur, entities, 0)) as entities_cur",
        "sum(if(in_prev, entities, 0)) as entities_prev",
        f"max(case role {numbers} end) as role_no")])


def of_roles(ids: DataFrame, roles: Sequence[str]) -> DataFrame:
    return ids.filter(F.col("role_no").isin([ROLE_NAMES.index(r) for r in roles]))


def role_totals(ctx: Context, ids: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Ids per role and the entities summed over them, one wide row."""
    wide = []
    for role in roles:
        mine = f"role_no = {ROLE_NAMES.index(role)}"
        for month in ("cur", "prev"):
            wide.append(f"count_if({mine} and in_{month}) as {role}_ids_{month}")
            wide.append(f"coalesce(sum(if({mine}, entities_{month}, 0)), 0) "
                        f"as {role}_sum_{month}")
    return ctx.complete(ids.groupBy(*ctx.by).agg(*[F.expr(e) for e in wide]))
