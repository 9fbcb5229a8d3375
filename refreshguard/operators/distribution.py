"""How events spread over genders, ages, regions, providers and cohorts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions.measures import Measure, flag, note, to_long
from ..functions.ratios import percent, quote, share_list, share_text
from . import snapshots
from .intervals import region_counts
from .joins import join_intervals
from .marks import REGIONS
from .shared import SharedFrames
from .topk import top_share, top_with_total

CATEGORY = "distribution"


def _skipped(ctx: Context, check: str, details: str) -> DataFrame:
    return to_long(ctx.labels(), ctx.by, CATEGORY,
                   [note(check, "status", "SKIPPED", "WARN", details)])


# -- gender and age -------------------------------------------------------

def _demo_totals(ctx: Context, shared: SharedFrames | None, as_of: date | None) -> DataFrame:
    """Entities, and events of linked entities, per gender and age group.

    Events are counted per entity first, so the join with demographics meets
    every entity once however many events it has.
    """
    if shared is None:
        entities = (ctx.events().select(*ctx.by, F.col(ctx.profile.entity).alias("entity"))
                    .groupBy(*ctx.by, "entity").agg(F.count("*").alias("n_events")))
    else:
        entities = shared.entities
    conditions = {"total": "true", "gender_f": "gender = 'F'", "gender_m": "gender = 'M'",
                  "gender_other": "gender is null or gender not in ('F', 'M')"}
    conditions |= {f"age_{i}": f"age_group = '{g}'" for i, g in enumerate(snapshots.AGE_GROUPS)}
    counts = []
    for name, condition in conditions.items():
        counts.append(f"count_if({condition}) as {name}")
        counts.append(f"coalesce(sum(if(linked and ({condition}), n_events, 0)), 0) as ev_{name}")
    rows = snapshots.with_demographics(ctx, entities, as_of)
    return ctx.complete(rows.groupBy(*ctx.by).agg(*[F.expr(c) for c in counts]))


def _shares(check: str, columns: dict[str, str], status: str, what: str,
            sort_text: bool = False, prefix: str = "") -> list[Measure]:
    """A row per key that occurs, then one row with all of them as text."""
    rows, texts = [], []
    total = f"{prefix}total"
    for key, column in columns.items():
        n = prefix + column
        share = percent(n, total)
        rows.append(Measure(check, f"share_{key}", n, total, share, share, status,
                            quote(f"Share of {what}"), f"{n} > 0"))
        texts.append(f"if({n} > 0, {share_text(quote(key), share)}, null)")
    texts = f"array_compact(array({', '.join(texts)}))"
    text = f"array_join({f'array_sort({texts})' if sort_text else texts}, ', ')"
    rows.append(Measure(check, "distribution", "null", total, "null", text, status,
                        f"concat('Based on ', string({total}), {quote(' ' + what)})",
                        f"{total} > 0"))
    rows.append(note(check, "status", "SKIPPED", "INFO",
                     f"Nothing to share out among: {what}", f"{total} = 0"))
    return rows


GENDERS = {"F": "gender_f", "M": "gender_m", "other": "gender_other"}
AGES = {g: f"age_{i}" for i, g in enumerate(snapshots.AGE_GROUPS)}
DEMO_CHECKS = ("gender", "age", "events")


def _age_status(ctx: Context) -> str:
    """WARN if a known group is too small or the unknown group too large."""
    limits = ctx.thresholds
    odd = [f"{percent(AGES[g], 'total')} < {limits.age_group_percent}D"
           for g in snapshots.AGE_GROUPS[:-1]]
    odd.append(f"{percent(AGES['Unknown'], 'total')} > {limits.age_unknown_percent}D")
    return flag(" or ".join(odd), "WARN")


def demo_distribution(ctx: Context, shared: SharedFrames | None = None,
                      only: tuple[str, ...] = DEMO_CHECKS,
                      as_of: date | None = None) -> DataFrame:
    """Gender and age shares from one aggregation.

    ``gender`` and ``age`` are shares of distinct entities: one without
    demographics is of 'other' gender and in no age group.  ``events`` are
    shares of the events of entities that have demographics.
    """
    if not ctx.has(ctx.profile.entity):
        return _skipped(ctx, "demographic_distribution", f"Column {ctx.profile.entity} not found")
    measures = []
    if "gender" in only:
        measures += _shares("gender_distribution", GENDERS, "'INFO'", "entities")
    if "age" in only:
        measures += _shares("age_distribution", AGES, _age_status(ctx), "entities", True)
    if "events" in only:
        what = "linked events"
        measures += _shares("event_gender_distribution", GENDERS, "'INFO'", what, False, "ev_")
        measures += _shares("event_age_distribution", AGES, "'INFO'", what, True, "ev_")
    return to_long(_demo_totals(ctx, shared, as_of), ctx.by, CATEGORY, measures)


# -- top shares -----------------------------------------------------------

def _summary_measures(check: str, what: str, limit: float | None, total: str = "total",
                      top: str = "top", text: str | None = None) -> list[Measure]:
    first = top_share(top, total)
    status = "'INFO'" if limit is None else flag(f"{first} > {limit}D", "WARN")
    return [
        Measure(check, "distribution", "null", total, first, text or share_list(top, total), status,
                f"concat('Based on ', string({total}), {quote(' ' + what)})", f"{total} > 0"),
        note(check, "status", "SKIPPED", "INFO", f"No {what}", f"{total} = 0")]


def region_summary(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """Total and top regions of events in their region intervals.

    An event counts once per interval that contains it and in the NULL region
    if none does.
    """
    shared = shared or SharedFrames(ctx)
    counts = (shared.region_counts() if shared.marks_days
              else region_counts(ctx, shared.days, snapshots.regions(ctx)))
    return ctx.complete(top_with_total(counts, ctx.by, "region", ctx.thresholds.top_shares))


def region_distribution(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    if not ctx.has(ctx.profile.entity, ctx.profile.event_date):
        return _skipped(ctx, "state_distribution", "Entity or event date column not found")
    return to_long(region_summary(ctx, shared), ctx.by, CATEGORY, _summary_measures(
        "state_distribution", "events joined to regions", ctx.thresholds.top_region_percent))


def event_region_counts(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """Distinct event ids per region; unlinked events are left out."""
    shared = shared or SharedFrames(ctx)
    if shared.marks_days:
        return shared.marked_ids(REGIONS)
    pairs = join_intervals(ctx, shared, snapshots.regions(ctx), "inner")
    return (pairs.select(*ctx.by, "region", "event_id").distinct()
            .groupBy(*ctx.by, "region").agg(F.count("*").alias("n")))


def event_region_summary(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    return ctx.complete(top_with_total(event_region_counts(ctx, shared), ctx.by, "region",
                                       ctx.thresholds.top_shares))


def event_region_distribution(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    if not ctx.has(ctx.profile.entity, ctx.profile.event_date, ctx.profile.event_id):
        return _skipped(ctx, "event_state_distribution", "Entity, date or id column not found")
    return to_long(event_region_summary(ctx, shared), ctx.by, CATEGORY, _summary_measures(
        "event_state_distribution", "distinct event-region pairs", None))


def provider_summary(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """Total and top ids of each provider column."""
    ids = (shared or SharedFrames(ctx)).providers
    columns = ctx.present(ctx.profile.id_columns)
    structs = ", ".join(f"named_struct('id_column', '{c}', 'n', n_{c})" for c in columns)
    counts = ids.selectExpr(*ctx.by, "id", f"inline(array({structs}))").filter("n > 0")
    return top_with_total(counts, [*ctx.by, "id_column"], "id", ctx.thresholds.top_shares)


def provider_distribution(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    columns = ctx.present(ctx.profile.id_columns)
    if not columns:
        return _skipped(ctx, "provider_distribution", "No provider column found")
    by_column = provider_summary(ctx, shared)
    # One wide row, so that a column without any id still gets its row.
    totals = [F.coalesce(F.max(F.when(F.col("id_column") == c, F.col("total"))), F.lit(0))
              .alias(f"total_{c}") for c in columns]
    tops = [F.max(F.when(F.col("id_column") == c, F.col("top"))).alias(f"top_{c}")
            for c in columns]
    wide = ctx.complete(by_column.groupBy(*ctx.by).agg(*totals, *tops))
    measures = [m for c in columns for m in _summary_measures(
        f"{c}_distribution", f"events with {c}", ctx.thresholds.top_provider_percent,
        f"total_{c}", f"top_{c}")]
    return to_long(wide, ctx.by, CATEGORY, measures)


def cohort_summary(ctx: Context) -> DataFrame:
    """Events and distinct entities of the top cohorts, ranked by entities."""
    profile = ctx.profile
    cohort = profile.cohort_label
    counts = (ctx.events().filter(F.col(cohort).isNotNull())
              .groupBy(*ctx.by, F.col(cohort).alias("cohort"))
              .agg(F.count("*").alias("n"), F.count_distinct(profile.entity).alias("n_entities")))
    return ctx.complete(top_with_total(counts, ctx.by, "cohort", ctx.thresholds.top_shares,
                                       order_by="n_entities"))


def cohort_distribution(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """The text shows entities; the status looks at the first one's event share."""
    if not ctx.has(ctx.profile.cohort_label, ctx.profile.entity):
        return _skipped(ctx, "cohort_distribution", "Cohort or entity column not found")
    text = "array_join(transform(top, x -> concat(x.key, ': ', string(x.m), ' patients')), ', ')"
    return to_long(cohort_summary(ctx), ctx.by, CATEGORY, _summary_measures(
        "cohort_distribution", f"events with {ctx.profile.cohort_label}",
        ctx.thresholds.top_cohort_percent, text=text))
