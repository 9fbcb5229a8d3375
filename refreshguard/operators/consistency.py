"""Date order inside a row, and events against the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import OWN, Context
from ..functions import months, rules
from ..functions.measures import count_of, flag, note, percent_of, to_long
from . import snapshots
from .intervals import uncovered
from .joins import join_intervals
from .marks import ENROLLED
from .scan import ROWS, ScanChecks, run_scan
from .shared import SharedFrames

CATEGORY = "consistency"


def _skipped(ctx: Context, check: str, details: str) -> DataFrame:
    return to_long(ctx.labels(), ctx.by, CATEGORY,
                   [note(check, "status", "SKIPPED", "WARN", details)])


# -- inside a row ---------------------------------------------------------

def date_order_checks(ctx: Context) -> ScanChecks:
    """Filled before written, or started after the end."""
    profile = ctx.profile
    checks = ScanChecks(CATEGORY)
    if ctx.has(profile.event_date, profile.written_date):
        found = checks.count_if(
            "filled_early", rules.earlier_than(profile.event_date, profile.written_date))
        text = f"records have {profile.event_date} before {profile.written_date}"
        checks.add(percent_of("fill_date_order", "invalid_date_percent", found, ROWS, "WARN",
                              text))
    if ctx.has(profile.event_date, profile.end_date):
        found = checks.count_if(
            "ends_early", rules.earlier_than(profile.end_date, profile.event_date))
        text = f"records have {profile.event_date} after {profile.end_date}"
        checks.add(percent_of("service_date_order", "invalid_date_percent", found, ROWS, "FAIL",
                              text))
    return checks


def date_order(ctx: Context) -> DataFrame:
    return run_scan(ctx, date_order_checks(ctx))


# -- references -----------------------------------------------------------

def count_missing(ctx: Context, marked: DataFrame) -> DataFrame:
    """Ids, each once, and how many of them are not ``known``."""
    return marked.groupBy(*ctx.by).agg(
        F.count("*").alias("n_ids"), F.expr("count_if(not known) as n_missing"))


def missing_entities(ctx: Context, shared: SharedFrames | None = None,
                     count_severity: str = "FAIL") -> DataFrame:
    """Distinct event entities (NULL is one of them) without demographics."""
    entity = ctx.profile.entity
    if not ctx.has(entity):
        return _skipped(ctx, "patient_demographics", f"Column {entity} not found")
    if shared is None:
        ids = ctx.events().select(*ctx.by, F.col(entity).alias("entity")).distinct()
    else:
        ids = shared.entities.filter("n_events > 0").drop("n_events")
    marked = snapshots.mark_known(ctx, ids, "demo", ctx.names.entity, "entity")
    wide = ctx.complete(count_missing(ctx, marked))
    text = "entities have no demographics"
    return to_long(wide, ctx.by, CATEGORY, [
        percent_of("patient_demographics", "missing_patient_percent", "n_missing", "n_ids", "WARN",
                   text),
        count_of("patient_demographics", "missing_patient_count", "n_missing", "n_ids",
                 count_severity, text)])


def missing_providers(ctx: Context, shared: SharedFrames | None = None,
                      by_column: bool = True, pooled: bool = True) -> DataFrame:
    """Distinct provider ids that the provider table lacks.

    Per column, and for all columns pooled; INFO when there are no ids.
    """
    columns = ctx.present(ctx.profile.id_columns)
    if not columns:
        return _skipped(ctx, "provider_ids", "No provider column found")
    ids = (shared or SharedFrames(ctx)).providers
    marked = snapshots.mark_known(ctx, ids, "providers", ctx.names.provider, "id")
    counts = ["count(*) as n_ids", "count_if(not known) as n_missing"]
    for c in columns:
        counts += [f"count_if(n_{c} > 0) as ids_{c}",
                   f"count_if(n_{c} > 0 and not known) as missing_{c}"]
    wide = ctx.complete(marked.groupBy(*ctx.by).agg(*[F.expr(c) for c in counts]))
    measures = []
    if by_column:
        measures += [percent_of(
            f"{c}_provider", "missing_npi_percent", f"missing_{c}", f"ids_{c}", "WARN",
            f"{c} values are not in the provider table") for c in columns]
    if pooled:
        status = f"if(n_ids = 0, 'INFO', {flag('n_missing > 0', 'WARN')})"
        measures.append(count_of(
            "provider_ids", "missing_npi_count", "n_missing", "n_ids", None,
            "distinct ids are not in the provider table", status=status))
    return to_long(wide, ctx.by, CATEGORY, measures)


def demographic_stability(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """Entities of two months running whose gender or birth differs between their latest rows.

    Both months' latest rows come from one aggregation per entity; NULL is a
    value like any other.
    """
    check, names = "demographic_stability", ctx.names
    if not ctx.by and ctx.previous is None:
        return to_long(ctx.labels(), ctx.by, CATEGORY, [note(
            check, "status", "SKIPPED", "INFO", "Previous refresh month not provided")])
    refresh = F.col(names.refresh_date)
    first = months.shift(ctx.start, -1) if ctx.by else min(ctx.previous, ctx.month)
    rows = ctx.dimensions["demo"].filter(
        months.in_months(refresh, first, ctx.month) & F.col(names.entity).isNotNull()).select(
        months.month_start(refresh).alias(OWN), F.col(names.entity).alias("entity"),
        F.struct(refresh.alias("seen"), F.col(names.gender).alias("gender"),
                 F.col(names.birth).alias("birth")).alias("latest"))
    pairs = (ctx.pair(rows).groupBy(*ctx.by, "entity").agg(
        F.max(F.when(F.col("in_cur"), F.col("latest"))).alias("cur"),
        F.max(F.when(F.col("in_prev"), F.col("latest"))).alias("prev"))
        .filter("cur is not null and prev is not null"))
    wide = ctx.complete(pairs.groupBy(*ctx.by).agg(F.count("*").alias("n_both"), *[
        F.expr(f"count_if(not (cur.{c} <=> prev.{c})) as n_{c}") for c in ("gender", "birth")]))
    return to_long(wide, ctx.by, CATEGORY, [percent_of(
        check, f"{c}_changed_percent", f"n_{c}", "n_both", "WARN",
        f"entities of both months have another {c} than before") for c in ("gender", "birth")])


# -- intervals and deaths -------------------------------------------------

def outside_enrollment(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """Event rows on a day that no enrollment interval of the entity contains."""
    if not ctx.has(ctx.profile.entity):
        return _skipped(ctx, "enrollment_periods", f"Column {ctx.profile.entity} not found")
    shared = shared or SharedFrames(ctx)
    wide = (shared.uncovered() if shared.marks_days
            else uncovered(ctx, shared.days, snapshots.enrollment(ctx)))
    return to_long(wide, ctx.by, CATEGORY, [percent_of(
        "enrollment_periods", "outside_enrollment_percent", "n_outside", "n", "WARN",
        "events are outside every enrollment period")])


def outside_enrollment_events(ctx: Context, shared: SharedFrames | None = None) -> DataFrame:
    """The same by distinct event id: one outside row makes an event count."""
    if not ctx.has(ctx.profile.entity):
        return _skipped(ctx, "enrollment_periods", f"Column {ctx.profile.entity} not found")
    shared = shared or SharedFrames(ctx)
    if shared.marks_days:
        counts = shared.marked_ids(ENROLLED).select(*ctx.by, F.col("n").alias("n_outside"))
    else:
        outside = join_intervals(ctx, shared, snapshots.enrollment(ctx), "left_anti")
        # distinct() keeps a NULL event id, count_distinct() would not.
        ids = outside.select(*ctx.by, "event_id").distinct()
        counts = ids.groupBy(*ctx.by).agg(F.count("*").alias("n_outside"))
    wide = ctx.complete(counts)
    return to_long(wide, ctx.by, CATEGORY, [count_of(
        "enrollment_periods", "outside_enrollment_events", "n_outside", None, "WARN",
        "Distinct events outside every enrollment period")])


def after_death(ctx: Context, shared: SharedFrames | None = None, grace_days: int | None = None,
                share: bool = True, strict: bool = True) -> DataFrame:
    """Events after the entity's death.

    ``share`` gives the share of the events of deceased entities later than the
    grace period, ``strict`` the count after the day of death itself.  Events
    are summed per entity and day before the join.
    """
    if not ctx.has(ctx.profile.entity):
        return _skipped(ctx, "mortality_dates", f"Column {ctx.profile.entity} not found")
    grace = ctx.thresholds.death_grace_days if grace_days is None else grace_days
    joined = snapshots.with_death(ctx, (shared or SharedFrames(ctx)).days)
    wide = ctx.complete(joined.groupBy(*ctx.by).agg(*[
        F.expr(f"coalesce(sum(if({condition}, n, 0)), 0) as {name}")
        for name, condition in (("n", "death is not null"),
                                ("n_late", f"day > date_add(death, {grace})"),
                                ("n_after", "day > death"))]))
    measures = []
    if share:
        measures.append(percent_of(
            "mortality_dates", "after_death_percent", "n_late", "n", "FAIL",
            f"events of deceased entities are more than {grace} days after the death date"))
    if strict:
        measures.append(count_of(
            "mortality_dates", "after_death_count", "n_after", "n", "FAIL",
            "events of deceased entities are after the death date"))
    return to_long(wide, ctx.by, CATEGORY, measures)
