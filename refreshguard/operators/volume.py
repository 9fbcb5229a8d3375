"""How much there is of everything, and how it moved since the previous month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions.measures import Measure, change, compared, count_of, note, to_long
from ..functions.ratios import change_percent
from . import pairs
from .pairs import entity_totals, of_roles, role_ids, role_totals
from .topk import top_k

CATEGORY = "volume"

# Check name, count metric, metric of entities with the role,
# change metric, what is counted.
ROLE_METRICS = {
    "code": ("code_count", "current_count_codes", None, "change_percentage", "codes"),
    "provider": ("provider_metrics", "current_provider_count", "current_patients_with_provider",
                 "provider_count_change_percentage", "providers"),
    "organization": ("organization_metrics", "current_org_count", "current_patients_with_org",
                     "org_count_change_percentage", "organizations"),
    "payer": ("payer_metrics", "current_payer_count", "current_patients_with_payer",
              "payer_count_change_percentage", "payers"),
    "cohort": ("cohort_metrics", "current_cohort_count", "current_patients_with_cohort",
               "cohort_count_change_percentage", "cohorts"),
}
ROLES = tuple(ROLE_METRICS)
#: Characters of the names of cohorts in one metric row; more of them make further rows.
PAGE = 30_000


def present_roles(ctx: Context, wanted: Sequence[str] = ROLES) -> list[str]:
    return pairs.present_roles(ctx, wanted)


# -- measures -------------------------------------------------------------

def record_measures(ctx: Context) -> list[Measure]:
    return [compared("record_count", "current_count_rows", "records_cur", "records_prev"),
            change("record_count", "change_percentage", "records_cur", "records_prev",
                   ctx.thresholds.record_change, "records")]


def entity_measures(ctx: Context) -> list[Measure]:
    return [compared("patient_count", "current_count_patients", "entities_cur", "entities_prev"),
            change("patient_count", "change_percentage", "entities_cur", "entities_prev",
                   ctx.thresholds.count_change, "patients")]


def id_measures(ctx: Context, role: str) -> list[Measure]:
    check, metric, _, moved, what = ROLE_METRICS[role]
    current, previous = f"{role}_ids_cur", f"{role}_ids_prev"
    return [compared(check, metric, current, previous),
            change(check, moved, current, previous, ctx.thresholds.count_change, what)]


def with_role_measures(ctx: Context, role: str) -> list[Measure]:
    check, _, metric, _, what = ROLE_METRICS[role]
    if metric is None:
        return []
    current, previous = f"{role}_entities_cur", f"{role}_entities_prev"
    rows = [compared(check, metric, current, previous)]
    if role == "cohort":
        rows.append(change(check, "patients_with_cohort_change_percentage", current, previous,
                           ctx.thresholds.count_change, f"patients with {what}"))
    return rows


def _average(role: str, month: str) -> str:
    total, ids = f"{role}_sum_{month}", f"{role}_ids_{month}"
    return f"coalesce(try_divide(double({total}), double({ids})), 0D)"


def average_measures(ctx: Context, role: str) -> list[Measure]:
    """Average entities per id, to 2 places, and its change."""
    check = ROLE_METRICS[role][0]
    current, previous = _average(role, "cur"), _average(role, "prev")
    shown = f"round({current}, 2)"
    return [
        Measure(check, "avg_patients", f"{role}_sum_cur", f"{role}_ids_cur", shown, shown,
                "'INFO'", f"concat('Previous month: ', string(round({previous}, 2)))"),
        change(check, "avg_patients_change_percentage", current, previous,
               ctx.thresholds.count_change, "average patients", counts=False)]


def _empty(condition: str) -> Measure:
    return note("data_loading", "source_data", "EMPTY", "WARN", "No rows to count", condition)


def missing_role(role: str) -> Measure:
    status = "WARN" if role == "code" else "INFO"
    return note(ROLE_METRICS[role][0], "status", "SKIPPED", status,
                f"Column for {role} not found")


def _metrics(ctx: Context, wide: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    return to_long(wide, ctx.by, CATEGORY, measures)


def _absent(ctx: Context, roles: Sequence[str]) -> DataFrame:
    return _metrics(ctx, ctx.labels(), [missing_role(r) for r in roles])


# -- checks ---------------------------------------------------------------

def volume_counts(ctx: Context) -> DataFrame:
    """Current counts of everything: one row per metric."""
    roles = present_roles(ctx)
    totals = entity_totals(ctx, roles)
    ids = role_totals(ctx, role_ids(ctx, roles, by_entity=()), roles)

    def row(metric, value):
        return count_of("volume_counts", metric, value, None, None, "Current month")

    first = [row("record_count", "records_cur"), row("distinct_patient_count", "entities_cur")]
    first += [row(f"patients_with_{r}", f"{r}_entities_cur") for r in roles if r != "code"]
    second = [row(f"distinct_{r}_count", f"{r}_ids_cur") for r in roles]
    return _metrics(ctx, totals, first).unionByName(_metrics(ctx, ids, second))


def record_count(ctx: Context) -> DataFrame:
    wide = ctx.paired().groupBy(*ctx.by).agg(F.count_if("in_cur").alias("records_cur"),
                                             F.count_if("in_prev").alias("records_prev"))
    return _metrics(ctx, ctx.complete(wide), record_measures(ctx))


def entity_count(ctx: Context) -> DataFrame:
    return _metrics(ctx, entity_totals(ctx), entity_measures(ctx))


def role_metrics(ctx: Context, role: str) -> DataFrame:
    """Ids of a role and entities that have it."""
    if not present_roles(ctx, [role]):
        return _absent(ctx, [role])
    ids = role_totals(ctx, role_ids(ctx, [role], by_entity=()), [role])
    rows = _metrics(ctx, ids, id_measures(ctx, role))
    if ROLE_METRICS[role][2] is None:
        return rows
    return rows.unionByName(
        _metrics(ctx, entity_totals(ctx, [role]), with_role_measures(ctx, role)))


def averages(ctx: Context) -> DataFrame:
    """Average entities per provider and per organization, and the change."""
    roles = present_roles(ctx, ("provider", "organization"))
    if not roles:
        return _absent(ctx, ("provider", "organization"))
    wide = role_totals(ctx, role_ids(ctx, roles), roles)
    return _metrics(ctx, wide, [m for r in roles for m in average_measures(ctx, r)])


def top_ids(ctx: Context, roles: Sequence[str] = ("provider", "organization"),
            ids: DataFrame | None = None) -> DataFrame:
    """The current month's top ids of each role by entities, with the previous month.

    Both months of an id are one row already, so no lookup per id is needed.
    """
    found = present_roles(ctx, roles)
    ids = role_ids(ctx, found) if ids is None else ids
    current = of_roles(ids, found).filter("in_cur")
    best = top_k(current, [*ctx.by, "role"], [F.desc("entities_cur"), F.asc("id")],
                 ctx.thresholds.top_ids)
    moved = change_percent("entities_cur", "entities_prev")
    return best.selectExpr(*ctx.by, "role", "id", "entities_cur", "entities_prev",
                           f"{moved} as change_pct")


def top_id_metrics(ctx: Context, roles: Sequence[str] = ("provider", "organization", "cohort"),
                   ids: DataFrame | None = None) -> DataFrame:
    """One metric row per top id; the previous count is named if there was one."""
    rows = top_ids(ctx, roles, ids)
    details = ("concat('Patient count: ', string(entities_cur), if(entities_prev > 0, "
               "format_string(', Previous: %d, Change: %+.2f%%', entities_prev, change_pct), ''))")
    long = to_long(rows, [*ctx.by, "role"], CATEGORY, [Measure(
        "patient_distribution", "", "entities_cur", "entities_prev", "entities_cur",
        "entities_cur", "'INFO'", details, metric_sql="concat(role, ': ', id)")])
    return (long.withColumn("check_name", F.concat("role", F.lit("_"), "check_name"))
            .drop("role"))


# -- cohorts --------------------------------------------------------------

def cohort_ids(ctx: Context) -> DataFrame:
    return role_ids(ctx, ["cohort"])


def cohort_top(ctx: Context) -> DataFrame:
    """Rows and distinct entities of the current month's top cohorts."""
    profile = ctx.profile
    counts = (ctx.events().filter(F.col(profile.roles["cohort"]).isNotNull())
              .groupBy(*ctx.by, F.col(profile.roles["cohort"]).alias("cohort"))
              .agg(F.count("*").alias("n"), F.count_distinct(profile.entity).alias("n_entities")))
    return top_k(counts, ctx.by, [F.desc("n_entities"), F.asc("cohort")],
                 ctx.thresholds.top_ids)


def cohort_top_summary(ctx: Context, ids: DataFrame | None = None) -> DataFrame:
    """The first five cohorts as one text."""
    ids = cohort_ids(ctx) if ids is None else ids
    cohorts = of_roles(ids, ["cohort"]).filter("in_cur")
    best = top_k(cohorts, ctx.by, [F.desc("entities_cur"), F.asc("id")], 5)
    texts = F.array_sort(F.collect_list(F.struct(
        (-F.col("entities_cur")).alias("position"), "id", "entities_cur", "entities_prev")))
    wide = ctx.complete(best.groupBy(*ctx.by).agg(texts.alias("top")))
    text = ("array_join(transform(top, x -> "
            "concat(x.id, ': ', string(x.entities_cur), ' patients')), ', ')")
    return _metrics(ctx, wide, [Measure(
        "cohort_patient_distribution", "top_cohorts", shown=text,
        num="size(top)", keep="size(top) > 0",
        details="concat('Entities of the largest cohorts. Previous month: ', "
                "array_join(transform(top, x -> string(x.entities_prev)), ', '))")])


def cohort_shift_rows(ctx: Context, ids: DataFrame | None = None) -> DataFrame:
    """Every cohort that is new, missing or moved, one row each."""
    ids = cohort_ids(ctx) if ids is None else ids
    moved = F.expr(change_percent("entities_cur", "entities_prev"))
    kind = (F.when(F.col("in_cur") & ~F.col("in_prev"), F.lit("new"))
            .when(F.col("in_prev") & ~F.col("in_cur"), F.lit("missing"))
            .when(F.abs(moved) >= ctx.thresholds.cohort_shift_percent, F.lit("changed")))
    return (of_roles(ids, ["cohort"])
            .select(*ctx.by, F.col("id").alias("cohort"), kind.alias("kind"),
                    "in_prev", "entities_cur", "entities_prev", moved.alias("change_pct")))


def _shift_totals(ctx: Context, ids: DataFrame | None) -> DataFrame:
    """Counts per kind, with the names of all of them for the texts, on as many pages as these need.

    The rows of page 0 stand for the counts.  Where the names of a month are longer than ``PAGE``
    characters, cohorts are dealt out to pages by hash, so no row and no group
    grows with their number; each page lists its cohorts, largest move first.
    """
    kinds = ("changed", "new", "missing")
    text = F.when(F.col("kind") == "changed", F.concat(
        "cohort", F.lit(": "), F.format_string("%+.1f%%", "change_pct"))).otherwise(
            F.col("cohort"))
    rows = cohort_shift_rows(ctx, ids).withColumn("text", text)
    named = F.col("kind").isNotNull()
    totals = rows.groupBy(*ctx.by).agg(
        F.count_if("in_prev").alias("n_previous"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds],
        F.ceil(F.coalesce(F.sum(F.when(named, F.length("text") + 2)), F.lit(0)) / PAGE)
        .cast("int").alias("pages"))
    position = F.coalesce(-F.abs("change_pct"), F.lit(0.0))
    names = ["n_previous", *[f"n_{k}" for k in kinds]]
    shifted = rows.filter(named).withColumn("position", position)
    if ctx.by:  # one row a month, so it may be sent everywhere
        shifted = shifted.join(F.broadcast(totals), ctx.by)
    else:  # one row in all, a scalar of the plan
        one = totals.select(F.struct(*names, "pages")).scalar()
        shifted = shifted.withColumn("one", one).select("*", "one.*").drop("one")
    examples = (shifted
                .withColumn("page", F.when(F.col("pages") > 1, F.pmod(
                    F.xxhash64("cohort"), F.col("pages")).cast("int")).otherwise(0)))
    item = F.struct("position", "cohort", "text")
    listed = examples.groupBy(*ctx.by, "page").agg(*[F.max(c).alias(c) for c in names], *[
        F.array_sort(F.collect_list(F.when(F.col("kind") == k, item))).alias(f"items_{k}")
        for k in kinds])
    lists = {k: f"items_{k}" for k in kinds}
    both = (totals.select(*ctx.by, F.lit(0).alias("page"), *names,
                          *[F.lit(None).cast(listed.schema[c].dataType).alias(c)
                            for c in lists.values()])
            .unionByName(listed.select(*ctx.by, "page", *names, *lists.values())))
    merged = both.groupBy(*ctx.by, "page").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in names],
        *[F.coalesce(F.max(F.size(c)), F.lit(0)).alias(f"here_{k}") for k, c in lists.items()],
        *[F.array_join(F.transform(F.max(c), lambda x: x["text"]), ", ").alias(f"text_{k}")
          for k, c in lists.items()])
    return ctx.complete(merged)


def _shift_measures() -> list[Measure]:
    total = "(n_changed + n_new + n_missing)"
    parts = ", ".join(
        f"if(n_{kind} > 0, concat('{name} ', string(n_{kind}), ': ', text_{kind}), null)"
        for kind, name in (("changed", "Moved"), ("new", "Appeared"), ("missing", "Gone")))
    here = "(here_changed + here_new + here_missing)"
    listed = ", ".join(
        f"if(here_{kind} > 0, concat('{name}: ', text_{kind}), null)"
        for kind, name in (("changed", "Moved"), ("new", "Appeared"), ("missing", "Gone")))
    return [
        Measure("cohort_metrics", "cohort_distribution_changes", total, "null", total, total,
                "'WARN'", f"concat_ws('; ', {parts})",
                f"page = 0 and n_previous > 0 and {total} > 0"),
        _continued("cohort_metrics", "cohort_distribution_changes", here,
                   f"concat_ws('; ', {listed})", "n_previous > 0")]


def _continued(check: str, metric: str, here: str, details: str, some: str) -> Measure:
    """The names on a page behind the first one; the first page has the counts."""
    return Measure(check, "", here, "null", here, here, "'INFO'", details,
                   f"page > 0 and {some} and {here} > 0",
                   f"concat('{metric}, part ', string(page + 1))")


def _shift_measures_by_kind(ctx: Context) -> list[Measure]:
    limit = ctx.thresholds.cohort_list_warn
    some = "n_previous > 0 and (n_previous > n_missing or n_new > 0)"

    def word(count):
        return f"if({count} > {limit}, 'WARN', 'INFO')"

    rows = [Measure(
        "cohort_shifts", "significant_changes", "n_changed", "null", "n_changed",
        word("n_changed"), "'INFO'",
        "concat('Moved: ', text_changed)",
        f"page = 0 and {some} and n_changed > 0"),
        _continued("cohort_shifts", "significant_changes", "here_changed",
                   "concat('Moved: ', text_changed)", some)]
    for kind, month in (("new", "in this month"), ("missing", "in the month before")):
        count = f"n_{kind}"
        rows.append(Measure(
            "cohort_changes", f"{kind}_cohorts", count, "null", count, count, word(count),
            f"concat('Only {month}: ', text_{kind})",
            f"page = 0 and {some} and {count} > 0"))
        rows.append(_continued("cohort_changes", f"{kind}_cohorts", f"here_{kind}",
                               f"concat('Only {month}: ', text_{kind})", some))
    return rows


def cohort_shifts(ctx: Context) -> DataFrame:
    """New, missing and moved cohorts as one number; no row when there are none."""
    return _metrics(ctx, _shift_totals(ctx, None), _shift_measures())


def cohort_shifts_by_kind(ctx: Context) -> DataFrame:
    """Variant with a row per kind, compared only where both months have cohorts."""
    return _metrics(ctx, _shift_totals(ctx, None), _shift_measures_by_kind(ctx))


# -- nothing to count -----------------------------------------------------

def volume_empty(ctx: Context) -> DataFrame:
    """Rows for input that cannot be counted: no rows, no columns, no roles."""
    wide = ctx.complete(ctx.events().groupBy(*ctx.by).agg(F.count("*").alias("n")))
    rows = [_empty("n = 0")]
    essential = (ctx.profile.refresh_date, ctx.profile.entity)
    absent = [c for c in essential if not ctx.has(c)]
    if absent:
        rows.append(note("data_loading", "schema_check", "ERROR", "FAIL",
                         f"Missing essential columns: {', '.join(absent)}"))
    rows += [missing_role(r) for r in ROLES if r not in present_roles(ctx)]
    return _metrics(ctx, wide, rows)


def total_measures(ctx: Context) -> list[Measure]:
    """Measures over ``entity_totals`` with the roles present."""
    roles = present_roles(ctx)
    rows = [*record_measures(ctx), *entity_measures(ctx),
            _empty("records_cur = 0 and records_prev = 0")]
    for role in ROLES:
        rows += with_role_measures(ctx, role) if role in roles else [missing_role(role)]
    return rows


def id_metrics(ctx: Context, ids: DataFrame) -> DataFrame:
    """Everything that follows from ``role_ids``."""
    roles = present_roles(ctx)
    measures = [m for r in roles for m in id_measures(ctx, r)]
    measures += [m for r in roles if r in ("provider", "organization")
                 for m in average_measures(ctx, r)]
    result = _metrics(ctx, role_totals(ctx, ids, roles), measures)
    result = result.unionByName(top_id_metrics(ctx, ids=ids))
    if "cohort" in roles:
        shifts = [*_shift_measures(), *_shift_measures_by_kind(ctx)]
        result = (result.unionByName(cohort_top_summary(ctx, ids))
                  .unionByName(_metrics(ctx, _shift_totals(ctx, ids), shifts)))
    return result


def changes(ctx: Context) -> DataFrame:
    """Only the changes of the counts against the previous month."""
    roles = present_roles(ctx)
    first = [*record_measures(ctx), *entity_measures(ctx)]
    first += [m for r in roles for m in with_role_measures(ctx, r)]
    second = [m for r in roles for m in id_measures(ctx, r)]
    moved = [[m for m in rows if m.metric.endswith("change_percentage")]
             for rows in (first, second)]
    with_share = [r for r in roles if r == "cohort"]
    ids = role_totals(ctx, role_ids(ctx, roles, by_entity=()), roles)
    return (_metrics(ctx, entity_totals(ctx, with_share), moved[0])
            .unionByName(_metrics(ctx, ids, moved[1])))


def volume(ctx: Context) -> DataFrame:
    """The whole family from the two reductions."""
    if not ctx.has(ctx.profile.refresh_date, ctx.profile.entity):
        return volume_empty(ctx.with_(scope="all", start=None))
    roles = present_roles(ctx)
    result = _metrics(ctx, entity_totals(ctx, roles), total_measures(ctx))
    return result.unionByName(id_metrics(ctx, role_ids(ctx, roles))) if roles else result
