"""Month-over-month: entities that stay, come and go, and shifts per code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions.measures import Measure, count_of, flag, note, percent_of, to_long
from ..functions.ratios import change_percent, percent, quote
from .pairs import DRUG, entity_totals, of_roles, role_ids
from .topk import top_k

CATEGORY = "temporal"


def _overlap_measures(ctx: Context) -> list[Measure]:
    limits = ctx.thresholds
    status = flag(f"{percent('both', 'entities_prev')} < {limits.overlap_percent}D or "
                  f"{percent('new', 'entities_cur')} > {limits.new_percent}D", "WARN")
    return [
        percent_of("patient_overlap", "overlap_percentage", "both", "entities_prev", "WARN",
                   "entities of the previous month are back", status=status),
        percent_of("patient_overlap", "new_patients_percentage", "new", "entities_cur", "WARN",
                   "entities were not in the previous month", status=status)]


def _new_measures(ctx: Context) -> list[Measure]:
    return [percent_of("new_patients", "new_patients_percentage", "new_any", "cur_any", "WARN",
                       "entities are new", limit=ctx.thresholds.new_percent)]


def _retention_measures(ctx: Context) -> list[Measure]:
    return [percent_of("patient_retention", "retention_rate", "both", "prev_any", "WARN",
                       "previous entities are back", limit=ctx.thresholds.retention_percent,
                       below=True)]


def _count_measures() -> list[Measure]:
    """Plain counts and shares; shares only where both months have entities."""
    some = "entities_cur > 0 and entities_prev > 0"
    rows = [count_of("patient_count", "current_month", "entities_cur", None, None,
                     "Distinct entities in the current refresh"),
            count_of("patient_count", "previous_month", "entities_prev", None, None,
                     "No entities in the previous refresh; shares are skipped",
                     keep="entities_cur > 0 and entities_prev = 0")]
    for check, metric, part, whole in (
            ("overlapping_patients", "overlap", "both", "entities_prev"),
            ("appearing_patients", "new", "new", "entities_cur"),
            ("returning_patients", "returning", "both", "entities_prev")):
        rows += [count_of(check, f"{metric}_count", part, whole, None, "entities", keep=some),
                 percent_of(check, f"{metric}_percentage", part, whole, "WARN", "entities",
                            keep=some, status="'INFO'")]
    return rows


def overlap(ctx: Context) -> DataFrame:
    return to_long(entity_totals(ctx), ctx.by, CATEGORY, _overlap_measures(ctx))


def new_entities(ctx: Context) -> DataFrame:
    return to_long(entity_totals(ctx), ctx.by, CATEGORY, _new_measures(ctx))


def retention(ctx: Context) -> DataFrame:
    return to_long(entity_totals(ctx), ctx.by, CATEGORY, _retention_measures(ctx))


def entity_counts(ctx: Context) -> DataFrame:
    return to_long(entity_totals(ctx), ctx.by, CATEGORY, _count_measures())


def entity_measures(ctx: Context) -> list[Measure]:
    """All four checks on entities, over ``entity_totals``."""
    return [*_overlap_measures(ctx), *_new_measures(ctx), *_retention_measures(ctx),
            *_count_measures()]


# -- shifts per code ------------------------------------------------------

def code_changes(ctx: Context, ids: DataFrame | None = None) -> DataFrame:
    """Distinct entities per drug code in both months, and the change."""
    ids = role_ids(ctx, [DRUG]) if ids is None else ids
    return of_roles(ids, [DRUG]).selectExpr(
        *ctx.by, "id as code", "entities_cur as current", "entities_prev as previous",
        "entities_cur - entities_prev as change",
        f"{change_percent('entities_cur', 'entities_prev')} as change_pct")


def _change_text() -> Column:
    return F.format_string("%s from %d to %d (%+d, %+.1f%%)", "code", "previous", "current",
                           "change", "change_pct")


def _shift_summary(ctx: Context, shifted: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Number of shifted codes and the text of the first ``k``."""
    position = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = top_k(shifted, ctx.by, [c.asc() for c in order], k).select(
        *ctx.by, F.struct(position.alias("position"), _change_text().alias("text")).alias("item"),
        F.lit(None).cast("bigint").alias("part"))
    counts = shifted.groupBy(*ctx.by).agg(F.count("*").alias("part")).select(
        *ctx.by, F.lit(None).cast(best.schema["item"].dataType).alias("item"), "part")
    return ctx.complete(best.unionByName(counts).groupBy(*ctx.by).agg(
        F.coalesce(F.sum("part"), F.lit(0)).alias("shifted"),
        F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda x: x["text"]), "; ")
        .alias("text")))


def _shift_measure(found: str, limits, check: str = "medication_changes") -> Measure:
    text = f" codes with an entity count beyond {limits.code_shift_percent:g}% of change; first: "
    return Measure(check, "significant_changes_count", found, "null", found, found,
                   flag(f"{found} > 0", "WARN"),
                   f"concat(string({found}), {quote(text)}, coalesce(text, ''))")


def _no_code(ctx: Context, check: str = "medication_changes") -> DataFrame:
    return to_long(ctx.labels(), ctx.by, CATEGORY, [note(
        check, "status", "SKIPPED", "INFO",
        f"Column {ctx.profile.drug_code} not available")])


def code_shifts(ctx: Context, ids: DataFrame | None = None) -> DataFrame:
    """Codes whose entity count moved by more than the limit.

    A code without previous entities has change 0 and is not reported.
    """
    if not ctx.has(ctx.profile.drug_code):
        return _no_code(ctx)
    limits = ctx.thresholds
    shifted = code_changes(ctx, ids).filter(
        (F.abs("change_pct") > limits.code_shift_percent)
        & (F.col("current") >= limits.code_shift_minimum))
    summary = _shift_summary(ctx, shifted, [-F.abs("change_pct"), F.col("code")], 5)
    return to_long(summary, ctx.by, CATEGORY, [_shift_measure("shifted", limits)])


def code_shifts_by_count(ctx: Context, ids: DataFrame | None = None) -> DataFrame:
    """Variant under its own name: more than the minimum, ranked by count change."""
    if not ctx.has(ctx.profile.drug_code):
        return _no_code(ctx, "medication_changes_by_count")
    limits = ctx.thresholds
    shifted = code_changes(ctx, ids).filter(
        (F.abs("change_pct") > limits.code_shift_percent)
        & (F.col("current") > limits.code_shift_minimum))
    summary = _shift_summary(ctx, shifted, [-F.abs("change"), F.col("code")], 5)
    return to_long(summary, ctx.by, CATEGORY, [
        _shift_measure("shifted", limits, "medication_changes_by_count")])


def skipped_family(ctx: Context) -> DataFrame:
    """The row that stands for the family when there is no previous month."""
    return to_long(ctx.labels(), ctx.by, CATEGORY, [note(
        "execution_status", "status", "SKIPPED", "INFO", "Previous refresh month not provided")])


def temporal(ctx: Context) -> DataFrame:
    ids = role_ids(ctx, [DRUG]) if ctx.has(ctx.profile.drug_code) else None
    return (to_long(entity_totals(ctx), ctx.by, CATEGORY, entity_measures(ctx))
            .unionByName(code_shifts(ctx, ids)).unionByName(code_shifts_by_count(ctx, ids)))
