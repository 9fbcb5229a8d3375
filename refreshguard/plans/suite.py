"""Running families of checks over tables, in one plan or one by one."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import OWN, Context
from ..functions import months
from ..functions.formats import RESULT_SCHEMA, to_results
from ..functions.measures import METRIC_COLUMNS, METRIC_SCHEMA, rows_of
from ..operators import (completeness, consistency, distribution, generic, marks, pairs, scan, temporal,
                         uniqueness, validity, volume)
from ..operators.shared import SharedFrames
from ..sources import history
from ..sources.shared import stored

log = logging.getLogger(__name__)

Check = Callable[[Context], DataFrame]


# Checks that are conditional counts over the events: all of them together are
# one aggregation.
SCAN_CHECKS: Mapping[str, Callable[[Context], list]] = {
    "completeness": completeness.family_checks,
    "validity": lambda ctx: [validity.rule_set(ctx)],
    "consistency": lambda ctx: [consistency.date_order_checks(ctx)],
}
# Checks that are plans of their own over shared reductions.
PLAN_CHECKS: Mapping[str, Sequence[Callable[[Context, SharedFrames], DataFrame]]] = {
    "consistency": (consistency.demographic_stability, consistency.missing_entities,
                    consistency.outside_enrollment,
                    consistency.outside_enrollment_events, consistency.after_death,
                    consistency.missing_providers),
    "uniqueness": (lambda ctx, _: uniqueness.uniqueness(ctx),),
    "distribution": (distribution.demo_distribution, distribution.region_distribution,
                     distribution.event_region_distribution, distribution.provider_distribution,
                     distribution.cohort_distribution),
}
FAMILIES = ("completeness", "consistency", "uniqueness", "distribution", "temporal", "validity",
            "volume")
COMPARING = ("temporal", "volume")
NEEDS = {"consistency": ("demo", "enroll", "mortality", "providers"),
         "distribution": ("demo", "geo")}


def select_families(names: Iterable[str] = ("all",)) -> list[str]:
    """Validated family names; ``all`` stands for every family."""
    names = list(names)
    if "all" in names:
        return list(FAMILIES)
    unknown = sorted(set(names) - set(FAMILIES))
    if unknown:
        raise ValueError(f"unknown checks: {', '.join(unknown)}; known: {', '.join(FAMILIES)}")
    return [f for f in FAMILIES if f in names]


def error_row(ctx: Context, family: str, error: BaseException) -> DataFrame:
    """A metric row (one per month in a range) that stands for a failed family."""
    text = f"Error executing check: {error}"[:500]
    row = (family, "execution_status", "status", None, None, None, "ERROR", "FAIL", text)
    rows = ctx.spark.createDataFrame([row], METRIC_SCHEMA)
    if not ctx.by:
        return rows
    literals = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, rows.schema.fields)]
    return ctx.spine().select(*ctx.by, *literals)


def _plain(ctx: Context, frame: DataFrame) -> DataFrame:
    return frame.select(*ctx.by, *METRIC_COLUMNS)


def _check_dimensions(ctx: Context, family: str) -> None:
    absent = [d for d in NEEDS.get(family, ()) if d not in ctx.dimensions]
    if absent:
        raise ValueError(f"{family} needs the dimensions {', '.join(absent)}")


def _skips_comparison(ctx: Context) -> bool:
    return ctx.scope != "range" and ctx.previous is None


def _comparison(ctx: Context, families: Sequence[str], shared: SharedFrames) -> list[DataFrame]:
    """Temporal and volume metrics from the same two reductions of the months."""
    if shared.lazy and families == ["volume"]:
        return [volume.volume(ctx)]
    if shared.lazy and families == ["temporal"]:
        return [temporal.temporal(ctx)]
    roles = volume.present_roles(ctx)
    ids = shared.ids([*roles, *pairs.present_roles(ctx, [pairs.DRUG])])
    structs, frames = [], []
    if "temporal" in families:
        structs += [m.as_struct(temporal.CATEGORY) for m in temporal.entity_measures(ctx)]
        frames += [temporal.code_shifts(ctx, ids), temporal.code_shifts_by_count(ctx, ids)]
    if "volume" in families:
        structs += [m.as_struct(volume.CATEGORY) for m in volume.total_measures(ctx)]
        frames.append(volume.id_metrics(ctx, ids))
    return [rows_of(shared.totals(roles), ctx.by, structs), *frames]


def comparison(ctx: Context, families: Sequence[str], shared: SharedFrames) -> list[DataFrame]:
    """The frames of the comparing families over given reductions."""
    return [_plain(ctx, p) for p in _comparison(ctx, families, shared)]


def _marking(ctx: Context, families: Sequence[str]) -> list[str]:
    """The dimensions that mark days in one pass, if the families ask for both of them."""
    kinds = {"consistency": marks.ENROLLED, "distribution": marks.REGIONS}
    together = [kinds[f] for f in families if f in kinds]
    profile = ctx.profile
    return together if len(together) == 2 and all(k in ctx.dimensions for k in together) and ctx.has(
        profile.entity, profile.event_date, profile.event_id) else []


def _parts(ctx: Context, families: Sequence[str], keep: bool = False, own: Sequence[Check] = (),
           shared: SharedFrames | None = None) -> list[DataFrame]:
    """The frames of some families; the checks among them share what they can, written first if ``keep``.

    The family ``custom`` is the checks ``own``; reductions that are ``shared`` already are used.
    """
    own = own if generic.CATEGORY in families else ()
    groups = [g for f in families if f in SCAN_CHECKS for g in SCAN_CHECKS[f](ctx)]
    groups += [c.group(ctx, f"own{k}_") for k, c in enumerate(own)
               if isinstance(c, generic.ScanBlock)]
    parts = [scan.run_scan(ctx, *groups)] if any(g.measures for g in groups) else []
    shared = SharedFrames(ctx, keep, _marking(ctx, families)) if shared is None else shared
    for family in families:
        _check_dimensions(ctx, family)
        parts += [check(ctx, shared) for check in PLAN_CHECKS.get(family, ())]
    comparing = [f for f in families if f in COMPARING]
    if "temporal" in comparing and _skips_comparison(ctx):
        # Volume goes on: its counts are the month's own, its changes not applicable.
        parts.append(temporal.skipped_family(ctx))
        comparing.remove("temporal")
    if comparing:
        parts += _comparison(ctx, comparing, shared)
    parts += generic.own_frames(ctx, own, shared)
    return [_plain(ctx, p) for p in parts]


def _plannable(ctx: Context, families: Sequence[str],
               own: Sequence[Check] = ()) -> tuple[list[str], list[DataFrame]]:
    """Families that can be planned, and ERROR rows for those that cannot."""
    good, failed = [], []
    for family in families:
        try:
            _parts(ctx, [family], own=own)
            good.append(family)
        except Exception as error:  # noqa: BLE001 - any failure becomes a row
            log.warning("%s could not be planned: %s", family, error)
            failed.append(_plain(ctx, error_row(ctx, family, error)))
    return good, failed


def family_frame(ctx: Context, family: str) -> DataFrame:
    """All metric rows of one family as one lazy frame."""
    return reduce(DataFrame.unionByName, _parts(ctx, select_families([family])))


def suite_metrics(ctx: Context, families: Iterable[str] = ("all",),
                  extra: Mapping[str, Check] | None = None, keep: bool = False) -> DataFrame:
    """Metric rows of the selected families (and own checks) as one lazy frame.

    The single-pass checks of all families are one aggregation and the others
    share their reductions, which ``keep`` computes and writes at once.  A family that
    cannot even be planned becomes an ERROR row, own checks like a family of theirs; errors at run time are isolated by
    ``run_suite``.
    """
    own = list((extra or {}).values())
    chosen = select_families(families) + ([generic.CATEGORY] if own else [])
    try:
        parts = _parts(ctx, chosen, keep, own)
    except Exception:  # noqa: BLE001 - find out which families fail
        chosen, parts = _plannable(ctx, chosen, own)
        if chosen:
            parts += _parts(ctx, chosen, keep, own)
    return reduce(DataFrame.unionByName, parts)


def suite_results(contexts: Iterable[Context], run_id: str, run_start_time: datetime,
                  families: Iterable[str] = ("all",), signed: bool = False) -> DataFrame:
    """Result rows of several tables as one lazy frame, for one append."""
    families = list(families)
    return history.combine([
        to_results(suite_metrics(c, families), run_id, run_start_time, c.profile.name, c.month,
                   signed) for c in contexts])


def run_suite(contexts: Iterable[Context], target: str, run_id: str, run_start_time: datetime,
              families: Iterable[str] = ("all",), signed: bool = False,
              fmt: str = "parquet", persist: bool = False, once: bool = False,
              keep: bool = False,
              extra: Mapping[str, Check] | None = None) -> dict[tuple[str, str], str]:
    """Write all families of every table, such that one failure stays one.

    The families are one plan that shares its reductions.  A frame is lazy and
    fails when it is written; then ``isolated`` narrows the failure down to
    families and months, whose rows become ERROR rows.  Returns the outcome per
    table and family: done, failed, or partial where only some months failed.

    Rows are appended, to a table or a path.  With ``once`` they are committed to
    a path under the run's id: families that the run has finished already are not
    run again, and a run that is repeated has its rows once.  ``persist`` keeps
    the compared months in memory and on disk for the length of the run: worth
    it if the events are costly to derive, not for a columnar table, of which every
    family reads just a few columns.  ``keep`` writes the reductions of the events
    first and plans every check over these small tables: for long ranges, where
    one plan of everything is very large.  ``extra`` are own checks, the family
    ``custom``.
    """
    outcome = {}
    own = list((extra or {}).values())
    chosen = select_families(families) + ([generic.CATEGORY] if own else [])
    for ctx in contexts:
        left = chosen
        if once:
            ready = history.finished(ctx.spark, target, run_id)
            left = [f for f in chosen if (ctx.profile.name, f) not in ready]
            outcome |= {(ctx.profile.name, f): "done" for f in chosen if f not in left}
        if not left:
            continue
        kept = ctx.compared().drop(OWN).persist(StorageLevel.MEMORY_AND_DISK) if (
            persist and ctx.scope != "all") else None
        if kept is not None:
            ctx = ctx.with_(events_table=kept, sample_rows=0)

        def write(rows: DataFrame, ctx: Context = ctx, left: Sequence[str] = left) -> None:
            rows = to_results(rows, run_id, run_start_time, ctx.profile.name, ctx.month, signed)
            if once:
                history.commit(rows, target, run_id, ctx.profile.name, left)
            else:
                history.append(rows, target, fmt)

        outcome |= _run_families(ctx, left, write, keep, own)
        if kept is not None:
            kept.unpersist()
    return outcome


@dataclass(frozen=True)
class Piece:
    """Computed metric rows of some families over the months of a context, or what failed there."""

    families: Sequence[str]
    rows: DataFrame
    failed: bool = False


def _computed(ctx: Context, families: Sequence[str], own: Sequence[Check],
              shared: SharedFrames | None = None) -> Piece:
    rows = reduce(DataFrame.unionByName, _parts(ctx, families, own=own, shared=shared))
    return Piece(families, stored(rows, "metrics"))


def halves(ctx: Context) -> list[Context]:
    """The two halves of a range of months; a single month, or another scope, is itself."""
    span = months.months_between(ctx.start, ctx.month) if ctx.by else 1
    if span == 1:
        return [ctx]
    middle = months.shift(ctx.start, span // 2)
    return [ctx.with_(month=months.shift(middle, -1)), ctx.with_(start=middle)]


def isolated(ctx: Context, families: Sequence[str], own: Sequence[Check] = (),
             by_family: bool = True, failed: Exception | None = None) -> list[Piece]:
    """The rows of the families over all months of the context, whatever fails.

    A failing plan is first tried family by family, over reductions that are written once, so the
    good families cost no second scan each.  Families that fail by
    themselves are tried over each half of the months, and so on; a single month
    that fails gives an ERROR row for each family that fails in it.  A month that
    cannot be read thus costs about twice the logarithm of the range in smaller runs.
    ``failed`` is how all of it together has failed already.
    """
    if failed is None:
        try:
            return [_computed(ctx, families, own)]
        except Exception as error:  # noqa: BLE001 - find out what fails
            failed = error
    log.warning("%s from %s to %s is narrowed down: %s", ctx.profile.name, ctx.start, ctx.month,
                failed)
    parts = halves(ctx)
    pieces: list[Piece] = []
    if len(families) == 1:
        errors = {families[0]: failed}
    elif by_family or len(parts) == 1:
        errors, shared = {}, SharedFrames(ctx, keep=True)
        for family in families:
            try:
                pieces.append(_computed(ctx, [family], own, shared))
            except Exception as error:  # noqa: BLE001 - any failure becomes a row
                log.warning("%s failed on %s: %s", family, ctx.profile.name, error)
                errors[family] = error
    else:
        errors = dict.fromkeys(families, failed)
    if len(parts) == 1:
        return pieces + [Piece([f], _plain(ctx, error_row(ctx, f, e)), True)
                         for f, e in errors.items()]
    if errors:
        for part in parts:
            pieces += isolated(part, list(errors), own, False)
    return pieces


def _outcomes(name: str, pieces: Sequence[Piece]) -> dict[tuple[str, str], str]:
    states: dict[str, set[bool]] = {}
    for piece in pieces:
        for family in piece.families:
            states.setdefault(family, set()).add(piece.failed)
    return {(name, f): "partial" if len(s) > 1 else "failed" if True in s else "done"
            for f, s in states.items()}


def _run_families(ctx: Context, families: Sequence[str], write: Callable[[DataFrame], None],
                  keep: bool = False,
                  own: Sequence[Check] = ()) -> dict[tuple[str, str], str]:
    """One plan for all families; narrowed down only if that fails (and has written nothing)."""
    name = ctx.profile.name
    try:
        write(reduce(DataFrame.unionByName, _parts(ctx, families, keep, own)))
        return {(name, family): "done" for family in families}
    except Exception as error:  # noqa: BLE001 - find out what fails
        pieces = isolated(ctx, families, own, failed=error)
    write(reduce(DataFrame.unionByName, [p.rows for p in pieces]))
    return _outcomes(name, pieces)


__all__ = ["COMPARING", "FAMILIES", "RESULT_SCHEMA", "Piece", "comparison", "error_row", "family_frame",
           "isolated", "run_suite", "select_families", "suite_metrics", "suite_results"]
