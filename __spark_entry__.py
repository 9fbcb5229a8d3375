"""

Scopes: checks on single rows, keys, dimensions and distributions run over the
events of every refresh; comparisons of months run for every month of the
table, each against the month before.  ``run_suite`` is the monthly run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import claim_views as cv
import oracle_queries as oq
from refreshguard import MEDICAL, PHARMACY, Context, Thresholds
from refreshguard.functions import months
from refreshguard.functions.formats import to_results

from refreshguard.operators import (completeness, consistency, distribution, generic, scan,
                                    snapshots, temporal, uniqueness, validity, volume)
from refreshguard.operators.topk import share_rows
from refreshguard.plans import backfill, state, suite
from refreshguard.plans.probe import schema_probe
from refreshguard.sources import history, tables
from refreshguard.sources.shared import shared_folder

try:
    import corpus_pipeline
    from refreshguard.llm import queries as text_queries
except ModuleNotFoundError as error:
    # Only the absence of the subpackage or of its pipeline is passed over.
    if error.name not in ("corpus_pipeline", "refreshguard.llm", "refreshguard.llm.queries"):
        raise
    corpus_pipeline = text_queries = None

RUN_ID = "run-1998-03"
RUN_START = datetime(2024, 1, 1, 12, 0, 0)
EARLIER_ID, EARLIER_START = "run-1998-02", datetime(2023, 12, 1, 12, 0, 0)
EMPTY_MONTH = "1994-01"
UNREADABLE = "1997-05"
HISTORY_FAMILIES = ["completeness", "uniqueness", "validity"]
OWN_CHECKS = {
    "nulls": generic.null_percent(["patient_id", "procedure_code"], limit=5.0),
    "rules": generic.predicate_percent({"late_service": "service_date > kh_refresh_date",
                                        "no_units": "units <= 0"}),
    "units": generic.allowed_values("unit_type", ["UN", "ml"], "FAIL"),
    "keys": generic.foreign_key_missing("billing_npi", "providers", "npi"),
    "enrolled": generic.interval_unmatched("enroll", "start_date", "end_date"),
    "cohorts": generic.top_share_rows("cohort_id", 3),
    "moved": generic.month_change("several_units", "units > 1", 0.3),
}
#: What they read of the events.
OWN_COLUMNS = ("patient_id", "kh_refresh_date", "service_date", "procedure_code", "units",
               "unit_type", "billing_npi", "cohort_id")


# -- inputs ---------------------------------------------------------------

def _all(spark: SparkSession, sf: str, profile=MEDICAL, **changes) -> Context:
    return cv.context(spark, sf, profile, **changes)


def _month(spark: SparkSession, sf: str, profile=MEDICAL, **changes) -> Context:
    return cv.context(spark, sf, profile, scope="month", **changes)


def _months(spark: SparkSession, sf: str, profile=MEDICAL) -> Context:
    return backfill.over_months(cv.context(spark, sf, profile), cv.FIRST_MONTH, cv.LAST_MONTH)


def _rows(frame: DataFrame, *checks: str, metric: str | None = None,
          category: bool = False) -> DataFrame:
    """The numeric columns of metric rows, optionally of some checks only."""
    if checks:
        frame = frame.filter(F.col("check_name").isin(list(checks)))
    if metric:
        frame = frame.filter(F.col("metric_name").endswith(metric))
    by = [months.label(F.col("month")).alias("refresh_month")] if "month" in frame.columns else []
    extra = ["check_category"] if category else []
    return frame.select(*by, *extra, "check_name", "metric_name", "num", "den",
                        F.round("value", 4).alias("value"), "status")


def _shares(frame: DataFrame, key: str) -> DataFrame:
    return frame.select(key, "n", F.round("share", 4).alias("share"))


# -- sources, sinks, runs -------------------------------------------------

def _scan(spark, sf):
    return cv.view(spark, sf, "mx_events").select(
        "medical_event_id", "patient_id", "kh_refresh_date", "service_date", "procedure_code",
        "units")


SAMPLE_ROWS = 1000
SAMPLE_COLUMNS = ("medical_event_id", "service_date", "procedure_code", "units", "unit_type",
                  "billing_npi", "rendering_npi", "referring_npi", "ndc11", "procedure_code_type",
                  "patient_id", "kh_plan_id")


def _sample(spark, sf):
    events = cv.view(spark, sf, "mx_events").select(*SAMPLE_COLUMNS)
    return tables.sample(events, SAMPLE_ROWS, SAMPLE_COLUMNS)


def _latest_month(spark, sf):
    return tables.latest_refresh_month(cv.view(spark, sf, "mx_events"), "kh_refresh_date")


def _previous_month(spark, sf):
    return tables.previous_month(cv.view(spark, sf, "mx_events"), "kh_refresh_date", cv.MONTH)


def _result_columns(frame: DataFrame) -> DataFrame:
    return frame.select("run_id", "events_table_name", "refresh_month", "check_category",
                        "check_name", "metric_name", _stored_value(), "status")


def _stored_value():
    """The number that a stored text stands for; words have none."""
    return F.round(F.expr("try_cast(metric_value as double)"), 4).alias("value")


def _columns_of_counts(profile) -> list[str]:
    """What completeness and uniqueness read of the events."""
    return list(dict.fromkeys([profile.event_id, *profile.required, *profile.optional,
                               *profile.duplicate_key, *(profile.code_with_type or ())]))


def _two_tables(spark, sf) -> DataFrame:
    """Completeness and uniqueness of both tables, and a frame that does not fit."""
    parts = []
    for profile in (MEDICAL, PHARMACY):
        ctx = _all(spark, sf, profile)
        ctx = cv.kept(ctx, *ctx.present(_columns_of_counts(profile)))
        for family in ("completeness", "uniqueness"):
            parts.append(to_results(suite.family_frame(ctx, family), RUN_ID, RUN_START,
                                    profile.name, cv.MONTH))
    parts += [None, cv.view(spark, sf, "providers"), history.empty_results(spark)]
    return history.combine(parts)


def _combine(spark, sf):
    return _result_columns(_two_tables(spark, sf))


def _two_runs(spark, sf) -> list[DataFrame]:
    runs = []
    for run_id, start, month in ((EARLIER_ID, EARLIER_START, cv.PREVIOUS),
                                 (RUN_ID, RUN_START, cv.MONTH)):
        ctx = cv.month_context(spark, sf, month=month)
        runs.append(to_results(suite.suite_metrics(ctx, ["completeness", "validity"]), run_id,
                               start, ctx.profile.name, month))
    return runs


def _history(spark, sf) -> DataFrame:
    """Two appended runs, read back."""
    target = shared_folder(spark, "results")
    for run in _two_runs(spark, sf):
        history.append(run, target)
    return history.read_history(spark, target)


def _append(spark, sf):
    return _result_columns(_history(spark, sf))


def _latest_run(spark, sf):
    latest = history.latest_run(_history(spark, sf))
    return latest.select("check_category", "check_name", "metric_name", _stored_value(), "status")


def _backfill(spark, sf):
    frame = backfill.backfill_metrics(cv.kept(_all(spark, sf)), cv.FIRST_MONTH, cv.LAST_MONTH,
                                      keep=True)
    return _rows(frame, category=True)


def _suite(spark, sf, profiles=(MEDICAL, PHARMACY)):
    out = None
    for profile in profiles:
        ctx = cv.kept(cv.month_context(spark, sf, profile))
        rows = _rows(suite.suite_metrics(ctx), category=True)
        rows = rows.withColumn("events_table_name", F.lit(profile.name))
        out = rows if out is None else out.unionByName(rows)
    return out


def _all_months(spark, sf):
    """Every family over every month of both tables, planned over stored reductions."""
    out = None
    for profile in (MEDICAL, PHARMACY):
        ctx = cv.kept(_months(spark, sf, profile))
        rows = _rows(suite.suite_metrics(ctx, keep=True), category=True)
        rows = rows.withColumn("events_table_name", F.lit(profile.name))
        out = rows if out is None else out.unionByName(rows)
    return out


def _month_state(spark, sf):
    """The comparing families of both tables for every month, from the kept state of the months."""
    out = None
    for profile in (MEDICAL, PHARMACY):
        ctx = _months(spark, sf, profile)
        path = shared_folder(spark, "state")
        state.save(ctx, path)
        rows = _rows(state.compare(ctx, path), category=True)
        rows = rows.withColumn("events_table_name", F.lit(profile.name))
        out = rows if out is None else out.unionByName(rows)
    return out


def _custom(spark, sf):
    ctx = cv.kept(_all(spark, sf), *OWN_COLUMNS)
    return _rows(suite.suite_metrics(ctx, [], OWN_CHECKS), category=True)


def _signed(spark, sf):
    """The changes of all counts in the notation with a sign."""
    rows = to_results(volume.changes(_months(spark, sf)), RUN_ID, RUN_START, MEDICAL.name,
                      signed=True)
    return rows.select("refresh_month", "check_name", "metric_name", "metric_value", "status")


def _error_rows(spark, sf):
    """A family whose dimension is not there, beside one that runs."""
    ctx = _all(spark, sf)
    bare = {name: ctx.dimensions[name] for name in ctx.dimensions if name != "geo"}
    return _rows(suite.suite_metrics(ctx.with_(dimensions=bare), ["uniqueness", "distribution"]),
                 category=True)


def _unreadable(spark, sf):
    """A backfill over all months, in one of which every value but the refresh date fails."""
    ctx = cv.kept(_all(spark, sf))
    fail = f"trunc(kh_refresh_date, 'MM') = date'{UNREADABLE}-01'"
    columns = [c if c == "kh_refresh_date" else
               f"if({fail}, cast(raise_error('unreadable') as {t}), {c}) as {c}"
               for c, t in ctx.events_table.dtypes]
    target = shared_folder(spark, "results")
    backfill.run_backfill(ctx.with_(events_table=ctx.events_table.selectExpr(*columns)),
                          cv.FIRST_MONTH, cv.LAST_MONTH, target, RUN_ID, RUN_START,
                          HISTORY_FAMILIES)
    return _result_columns(history.read_history(spark, target))


def _rerun(spark, sf):
    """Both tables over all months, the run made twice under one id."""
    target = shared_folder(spark, "results")
    contexts = [cv.kept(_months(spark, sf, p)) for p in (MEDICAL, PHARMACY)]
    for families in (HISTORY_FAMILIES[:2], HISTORY_FAMILIES):
        suite.run_suite(contexts, target, RUN_ID, RUN_START, families, once=True)
    return _result_columns(history.read_committed(spark, target))


def _first_month(spark, sf):
    """The first month has nothing before it: comparisons are skipped, volume is counted."""
    ctx = cv.kept(cv.month_context(spark, sf, month=cv.FIRST_MONTH, previous=None))
    return _rows(suite.suite_metrics(ctx, ["temporal", "volume"]), category=True)


def _probe(spark, sf):
    parts = []
    for profile in (MEDICAL, PHARMACY):
        parts.append(schema_probe(_all(spark, sf, profile))
                     .withColumn("events_table_name", F.lit(profile.name)))
    return parts[0].unionByName(parts[1])


# -- dimensions -----------------------------------------------------------

def _latest(spark, sf):
    demo = cv.view(spark, sf, "patient_demo")
    return snapshots.latest_per_key(demo, ["patient_id"], "kh_refresh_date", "patient_gender",
                                    "patient_yob")


def _ages(spark, sf):
    ctx = _all(spark, sf)
    entities = cv.view(spark, sf, "patient_demo").select(
        F.col("patient_id").alias("entity")).distinct()
    aged = snapshots.with_demographics(ctx, entities, cv.AGE_AS_OF).filter("linked")
    return aged.groupBy("age_group").agg(F.count("*").alias("n"))


# -- checks ---------------------------------------------------------------

def _scan_checks(make, profile=MEDICAL):
    return lambda spark, sf: _rows(_run_scan(_all(spark, sf, profile), make))


def _run_scan(ctx, make):
    return scan.run_scan(ctx, make(ctx))


def _missing_columns(spark, sf):
    return _rows(_run_scan(_all(spark, sf, PHARMACY), completeness.missing_column_checks))


def _valid(check, profile=MEDICAL, **limits):
    def query(spark, sf):
        ctx = _all(spark, sf, profile, thresholds=Thresholds(**limits))
        return _rows(validity.validity(ctx, [check]))
    return query


def _npi_format(spark, sf):
    ctx = _all(spark, sf)
    return _rows(validity.validity(ctx, [f"{c}_format" for c in MEDICAL.id_columns]))


def _check(function, profile=MEDICAL, metric=None, **changes):
    return lambda spark, sf: _rows(function(_all(spark, sf, profile, **changes)), metric=metric)


def _monthly(function, profile=MEDICAL, metric=None):
    return lambda spark, sf: _rows(function(_months(spark, sf, profile)), metric=metric)


def _regions(spark, sf):
    return _shares(share_rows(distribution.region_summary(_all(spark, sf)), [], "patient_state"),
                   "patient_state")


def _event_regions(spark, sf):
    rows = share_rows(distribution.event_region_summary(_all(spark, sf)), [], "patient_state")
    return _shares(rows, "patient_state")


def _providers(spark, sf):
    rows = share_rows(distribution.provider_summary(_all(spark, sf)), ["id_column"], "id")
    return rows.select("id_column", "id", "n", F.round("share", 4).alias("share"))


def _cohorts(spark, sf):
    rows = share_rows(distribution.cohort_summary(_all(spark, sf)), [], "cohort")
    return rows.select("cohort", "n", F.col("m").alias("n_entities"),
                       F.round("share", 4).alias("share"))


def _demo_check(part, **changes):
    return lambda spark, sf: _rows(distribution.demo_distribution(
        _all(spark, sf, **changes), only=(part,), as_of=cv.AGE_AS_OF))


def _by_month(frame: DataFrame) -> DataFrame:
    return frame.withColumn("month", months.label(F.col("month"))).withColumnRenamed(
        "month", "refresh_month")


def _top_providers(spark, sf):
    rows = volume.top_ids(_months(spark, sf))
    return _by_month(rows.select("month", "role", "id", F.col("entities_cur").alias("n")))


def _top_providers_change(spark, sf):
    rows = volume.top_ids(_months(spark, sf))
    return _by_month(rows.select("month", "role", "id", F.col("entities_cur").alias("n"),
                                 F.col("entities_prev").alias("n_previous"),
                                 F.round("change_pct", 4).alias("change_pct")))


def _cohort_top(spark, sf):
    return _by_month(volume.cohort_top(_months(spark, sf)))


def _role(role, metric=None):
    return _monthly(lambda ctx: volume.role_metrics(ctx, role), metric=metric)


def _volume_empty(spark, sf):
    """A month without rows, and a table without payer and cohort."""
    return _rows(volume.volume_empty(_month(spark, sf, PHARMACY, month=EMPTY_MONTH)))


def _validity_empty(spark, sf):
    return _rows(validity.validity_empty(_month(spark, sf, month=EMPTY_MONTH)))


def entry(spark: SparkSession) -> DataFrame:
    """The whole monthly run over the medical events of 1998-03, as result rows."""
    ctx = _month(spark, "/root/testdata/sf0.001")
    return suite.suite_results([ctx], RUN_ID, RUN_START)


def _text_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries on training text, if their subpackage is there."""
    if text_queries is None:
        return {}
    return text_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def _text_oracle_sql() -> dict[str, str]:
    if text_queries is None:
        return {}
    pipeline = corpus_pipeline.ORACLE_SQL
    return text_queries.ORACLE_SQL | ({} if pipeline is None else {"pipeline": pipeline})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _text_queries() | {
        # sources, sinks, runs
        "scan": _scan,
        "sample_limit": _sample,
        "combine_results": _combine,
        "result_append": _append,
        "latest_run_view": _latest_run,
        "latest_refresh_month": _latest_month,
        "previous_month": _previous_month,
        "month_backfill": _backfill,
        "run_suite": _suite,
        "suite_first_month": _first_month,
        "suite_all_months": _all_months,
        "month_state": _month_state,
        "custom_checks": _custom,
        "signed_results": _signed,
        "error_rows": _error_rows,
        "backfill_unreadable_month": _unreadable,
        "rerun_counts_once": _rerun,
        "schema_probe": _probe,
        "latest_per_key": _latest,
        "age_bucket": _ages,
        # completeness
        "required_null_pct": _scan_checks(completeness.required_checks),
        "optional_null_pct": _scan_checks(completeness.optional_checks),
        "missing_columns": _missing_columns,
        "code_type_consistency": _scan_checks(completeness.code_type_checks),
        "required_null_count": _scan_checks(completeness.required_count_checks),
        # uniqueness
        "pk_duplicate_pct": _check(uniqueness.key_duplicate_percent),
        "pk_duplicate_keys": _check(uniqueness.key_duplicate_count),
        "duplicate_records": _check(uniqueness.duplicate_records),
        # validity
        "future_dates": _valid("future_dates"),
        "old_dates": _valid("old_dates", old_year=cv.OLD_YEAR),
        "ndc_format": _valid("ndc_format"),
        "code_type_allowed": _valid("procedure_code_type"),
        "quantity_positive": _valid("quantity_positive", PHARMACY),
        "quantity_extreme": _valid("quantity_extreme", PHARMACY),
        "days_supply_positive": _valid("days_supply_positive", PHARMACY),
        "units_positive": _valid("units_positive"),
        "units_extreme": _valid("units_extreme"),
        "unit_type_allowed": _valid("unit_type"),
        "npi_format": _npi_format,
        "fill_before_written": _valid("fill_date_order", PHARMACY),
        "future_end_date": _valid("future_service_to_date"),
        "validity_single_pass": _check(validity.validity),
        "validity_single_pass_rx": _check(validity.validity, PHARMACY),
        "validity_empty": _validity_empty,
        # consistency
        "fill_date_order": _check(consistency.date_order, PHARMACY),
        "service_date_order": _check(consistency.date_order),
        "demographic_stability": _monthly(consistency.demographic_stability),
        "missing_entities": _check(consistency.missing_entities),
        "missing_entities_exact": _check(consistency.missing_entities, snapshot="exact"),
        "missing_entities_every": _check(consistency.missing_entities, snapshot="every"),
        "outside_enrollment_pct": _check(consistency.outside_enrollment),
        "outside_enrollment_events": _check(consistency.outside_enrollment_events),
        "after_death_pct": _check(consistency.after_death, metric="_percent"),
        "after_death_count": _check(consistency.after_death, metric="_count"),
        "missing_npi_by_column": _check(lambda ctx: consistency.missing_providers(ctx, pooled=False)),
        "missing_npi_pooled": _check(lambda ctx: consistency.missing_providers(ctx, by_column=False)),
        # distribution
        "gender_distribution": _demo_check("gender"),
        "age_distribution": _demo_check("age"),
        "event_demo_distribution": _demo_check("events"),
        "gender_distribution_every": _demo_check("gender", snapshot="every"),
        "age_distribution_every": _demo_check("age", snapshot="every"),
        "event_demo_distribution_every": _demo_check("events", snapshot="every"),
        "state_distribution": _regions,
        "event_state_distribution": _event_regions,
        "provider_distribution": _providers,
        "cohort_distribution": _cohorts,
        # temporal, every month against the one before
        "patient_overlap": _monthly(temporal.overlap, metric="overlap_percentage"),
        "new_patients_overlap": _monthly(temporal.overlap, metric="new_patients_percentage"),
        "new_patients": _monthly(temporal.new_entities),
        "patient_retention": _monthly(temporal.retention),
        "medication_changes": _monthly(temporal.code_shifts),
        "medication_changes_v4": _monthly(temporal.code_shifts_by_count),
        "patient_counts_returning": _monthly(temporal.entity_counts),
        # volume, every month against the one before
        "volume_counts": _monthly(volume.volume_counts),
        "record_count": _monthly(volume.record_count),
        "patient_count": _monthly(volume.entity_count),
        "code_count": _role("code"),
        "provider_metrics": _role("provider"),
        "organization_metrics": _role("organization"),
        "payer_metrics": _role("payer"),
        "cohort_metrics": _role("cohort"),
        "volume_change": _monthly(volume.changes),
        "cohort_patients_change": _role("cohort", "patients_with_cohort_change_percentage"),
        "avg_patients_per_provider": _monthly(volume.averages, metric="avg_patients"),
        "avg_patients_change": _monthly(volume.averages, metric="avg_patients_change_percentage"),
        "top_providers": _top_providers,
        "top_providers_change": _top_providers_change,
        "cohort_patients_topn": _cohort_top,
        "cohort_shifts": _monthly(volume.cohort_shifts),
        "cohort_shifts_v4": _monthly(volume.cohort_shifts_by_kind),
        "volume_empty": _volume_empty,
    }


# -- oracle ---------------------------------------------------------------

def _literal_run(scope: oq.Scope, run_id: str, families: list[str]) -> str:
    body = oq.suite_body(scope, families)
    return (f"select '{run_id}' as run_id, '{scope.table['table']}' as events_table_name, "
            f"strftime(m, '%Y-%m') as refresh_month, check_category, check_name, metric_name, "
            f"value, status from ({scope.ctes(body)} {body})")


def _absent_columns() -> str:
    rows = [f"('optional_fields', '{c}_null_percentage')" for c in oq.RX["absent"]]
    return ("select check_name, metric_name, cast(null as bigint) as num, cast(null as bigint) as "
            f"den, cast(null as double) as value, 'WARN' as status from (values {', '.join(rows)}) "
            "t(check_name, metric_name)")


def _probe_sql() -> str:
    parts = []
    for t in (oq.MX, oq.RX):
        absent = t.get("absent", [])
        wanted = [(c, "required") for c in t["required"]]
        wanted += [(c, "optional") for c in [*t["optional"], *absent]]
        wanted += [(c, f"role:{r}") for r, c in t["roles"].items()]
        if t is oq.RX:
            wanted.append(("cohort_id", "role:cohort"))
        for c, purpose in wanted:
            here = c not in absent and not (t is oq.RX and c == "cohort_id")
            filled = f"(select count({c}) from ({cv.oracle_view(t['table'])}))" if here else "0"
            parts.append(f"select '{t['table']}' as events_table_name, '{c}' as column_name, "
                         f"'{purpose}' as purpose, {str(here).lower()} as present, "
                         f"cast({filled} as bigint) as n_filled")
    return " union all ".join(parts)


def oracle_sql() -> dict[str, str]:
    mx, rx = oq.Scope(oq.MX), oq.Scope(oq.RX)
    ages = oq.Scope(oq.MX, age_year=cv.AGE_AS_OF.year)
    span = oq.Scope(oq.MX, "range")
    month, month_rx = oq.Scope(oq.MX, "month"), oq.Scope(oq.RX, "month")
    first_month = oq.Scope(oq.MX, "month", f"date '{cv.FIRST_MONTH}-01'")
    first_volume = oq.suite_body(first_month, ["volume"])
    empty = f"date '{EMPTY_MONTH}-01'"
    first = f"date '{cv.FIRST_MONTH}-01'"

    def check(scope, maker, *names, metric=None):
        where = []
        if names:
            where.append("check_name in (" + ", ".join(f"'{n}'" for n in names) + ")")
        if metric:
            where.append(f"metric_name like '%{metric}'")
        return oq.metrics(scope, [maker], " and ".join(where))

    def shares(scope, counts, key, order="n", extra=""):
        return (scope.ctes(counts) + f"select k as {key}, n, {extra}round("
                f"{oq.pct('n', 'total')}, 4) as share from ({oq.top_rows(counts, order)})")

    def by_month(body, columns):
        return (span.ctes(body) + f"select strftime(m, '%Y-%m') as refresh_month, {columns} "
                f"from ({body})")

    events = cv.oracle_view("mx_events")
    sample = ", ".join(SAMPLE_COLUMNS)
    sample_order = ", ".join(f"{c} nulls first" for c in SAMPLE_COLUMNS)
    tops = " union all ".join(oq.top_ids(span, r) for r in ("provider", "organization"))
    cohort_top = (f"select c.* from (select *, row_number() over (partition by m order by p desc, "
                  f"k) as rn from (select m, cohort_id as k, count(*) as n, count(distinct "
                  f"patient_id) as p from em where cohort_id is not null group by m, cohort_id)) c "
                  f"where rn <= 100")
    provider_tops = " union all ".join(
        oq.top_rows(oq.provider_counts(mx, c), extra=f"'{c}' as id_column, ")
        for c in oq.MX["npis"])
    demo = oq.latest_demo(ages)
    suite_parts = []
    for scope in (month, month_rx):
        body = oq.suite_body(scope)
        suite_parts.append(f"select '{scope.table['table']}' as events_table_name, check_category, "
                           f"check_name, metric_name, num, den, value, status "
                           f"from ({scope.ctes(body)} {body})")
    both = " union all ".join(_literal_run(s, RUN_ID, ["completeness", "uniqueness"])
                              for s in (mx, rx))
    runs = " union all ".join([
        _literal_run(oq.Scope(oq.MX, "month", f"date '{cv.PREVIOUS}-01'"), EARLIER_ID,
                     ["completeness", "validity"]),
        _literal_run(month, RUN_ID, ["completeness", "validity"])])
    backfill_body = oq.suite_body(span)
    every = oq.Scope(oq.MX, every=True)
    every_age = oq.Scope(oq.MX, every=True, age_year=cv.AGE_AS_OF.year)
    own_body = oq.custom_checks(mx)
    whole_parts, history_parts, state_parts = [], [], []
    for scope in (span, oq.Scope(oq.RX, "range")):
        body = oq.suite_body(scope)
        whole_parts.append(f"select '{scope.table['table']}' as events_table_name, "
                           f"strftime(m, '%Y-%m') as refresh_month, check_category, check_name, "
                           f"metric_name, num, den, value, status from ({scope.ctes(body)} {body})")
        body = oq.suite_body(scope, list(suite.COMPARING))
        state_parts.append(f"select '{scope.table['table']}' as events_table_name, "
                           f"strftime(m, '%Y-%m') as refresh_month, check_category, check_name, "
                           f"metric_name, num, den, value, status from ({scope.ctes(body)} {body})")
        history_parts.append(_literal_run(scope, RUN_ID, HISTORY_FAMILIES))
    broken = f"date '{UNREADABLE}-01'"
    failed = ", ".join(f"('{f}')" for f in HISTORY_FAMILIES)

    def valid(name, scope=mx):
        return check(scope, oq.validity, name)

    return _text_oracle_sql() | {
        "scan": f"select medical_event_id, patient_id, kh_refresh_date, service_date, "
                f"procedure_code, units from ({events})",
        "sample_limit": f"select {sample} from ({events}) order by {sample_order} "
                        f"limit {SAMPLE_ROWS}",
        "combine_results": both,
        "result_append": runs,
        "latest_run_view": f"select check_category, check_name, metric_name, value, status from ({runs}) "
                           f"where run_id = '{RUN_ID}'",
        "latest_refresh_month": f"select max(strftime(kh_refresh_date, '%Y-%m')) as latest_month "
                                f"from ({events})",
        "previous_month": f"select max(strftime(kh_refresh_date, '%Y-%m')) as previous_month from "
                          f"({events}) where kh_refresh_date >= date '{cv.PREVIOUS}-01' and "
                          f"kh_refresh_date < date '{cv.MONTH}-01'",
        "month_backfill": span.ctes(backfill_body) + "select strftime(m, '%Y-%m') as "
                          "refresh_month, check_category, check_name, metric_name, num, den, "
                          f"value, status from ({backfill_body})",
        "run_suite": " union all ".join(suite_parts),
        "suite_first_month": first_month.ctes(first_volume) + "select check_category, check_name, "
                             f"metric_name, num, den, value, status from ({first_volume}) union all "
                             f"select 'temporal', 'execution_status', 'status', cast(null as bigint), "
                             f"cast(null as bigint), cast(null as double), 'INFO' where not exists "
                             f"(select 1 from ({events}) where kh_refresh_date < {first})",
        "suite_all_months": " union all ".join(whole_parts),
        "month_state": " union all ".join(state_parts),
        "custom_checks": mx.ctes(own_body) + "select check_category, check_name, metric_name, num, "
                         f"den, value, status from ({own_body})",
        "signed_results": "select refresh_month, check_name, metric_name, case when den > 0 then "
                          "printf('%+.2f%%', round(cast(num - den as double) / den * 100, 2)) else "
                          "'N/A' end as metric_value, status from ("
                          + check(span, oq.volume_totals, metric="change_percentage") + ")",
        "error_rows": "select * from (" + mx.ctes() + "select check_category, check_name, "
                      "metric_name, num, den, value, status from (" + oq.suite_body(
                          mx, ["uniqueness"]) + ")) union all select 'distribution', "
                      "'execution_status', 'status', null, null, null, 'FAIL' from (select 1 from "
                      f"({events}) limit 1)",
        "backfill_unreadable_month": f"select * from ({_literal_run(span, RUN_ID, HISTORY_FAMILIES)}"
                                     f") where refresh_month <> '{UNREADABLE}' union all select "
                                     f"'{RUN_ID}', 'mx_events', '{UNREADABLE}', family, "
                                     "'execution_status', 'status', null, 'FAIL' from (values "
                                     f"{failed}) t(family) where exists (select 1 from ({events}) "
                                     f"where date_trunc('month', kh_refresh_date) = {broken})",
        "rerun_counts_once": " union all ".join(history_parts),
        "schema_probe": _probe_sql(),
        "latest_per_key": f"select patient_id, kh_refresh_date, patient_gender, patient_yob from "
                          f"(select *, row_number() over (partition by patient_id order by "
                          f"kh_refresh_date desc) as rn from ({cv.oracle_view('patient_demo')})) "
                          f"where rn = 1",
        "age_bucket": ages.ctes(demo) + f"select a as age_group, count(*) as n from ({demo}) "
                      f"group by a",
        "required_null_pct": check(mx, oq.completeness, "required_fields",
                                   metric="_null_percentage"),
        "optional_null_pct": check(mx, oq.completeness, "optional_fields"),
        "missing_columns": _absent_columns(),
        "code_type_consistency": check(mx, oq.completeness, "procedure_code_type_consistency"),
        "required_null_count": check(mx, oq.completeness, "required_fields", metric="_null_count"),
        "pk_duplicate_pct": check(mx, oq.uniqueness, metric="_duplicate_percentage"),
        "pk_duplicate_keys": check(mx, oq.uniqueness, metric="_duplicate_keys"),
        "duplicate_records": check(mx, oq.uniqueness, "duplicate_records"),
        "future_dates": valid("future_dates"),
        "old_dates": valid("old_dates", oq.Scope(oq.MX, old_year=cv.OLD_YEAR)),
        "ndc_format": valid("ndc_format"),
        "code_type_allowed": valid("procedure_code_type"),
        "quantity_positive": valid("quantity_positive", rx),
        "quantity_extreme": valid("quantity_extreme", rx),
        "days_supply_positive": valid("days_supply_positive", rx),
        "units_positive": valid("units_positive"),
        "units_extreme": valid("units_extreme"),
        "unit_type_allowed": valid("unit_type"),
        "npi_format": check(mx, oq.validity, *[f"{c}_format" for c in oq.MX["npis"]]),
        "fill_before_written": valid("fill_date_order", rx),
        "future_end_date": valid("future_service_to_date"),
        "validity_single_pass": check(mx, oq.validity),
        "validity_single_pass_rx": check(rx, oq.validity),
        "validity_empty": check(oq.Scope(oq.MX, "month", empty), oq.validity, "overall_validity"),
        "fill_date_order": check(rx, oq.date_order),
        "service_date_order": check(mx, oq.date_order),
        "demographic_stability": check(span, oq.stability),
        "missing_entities": check(mx, oq.missing_entities),
        "missing_entities_exact": check(oq.Scope(oq.MX, exact=True), oq.missing_entities),
        "missing_entities_every": check(every, oq.missing_entities),
        "gender_distribution_every": check(every, oq.gender),
        "age_distribution_every": check(every_age, oq.age),
        "event_demo_distribution_every": check(every_age, oq.event_demo),
        "outside_enrollment_pct": check(mx, oq.outside_enrollment),
        "outside_enrollment_events": check(mx, oq.outside_events),
        "after_death_pct": check(mx, oq.deaths, metric="_percent"),
        "after_death_count": check(mx, oq.deaths, metric="_count"),
        "missing_npi_by_column": check(mx, oq.providers_by_column),
        "missing_npi_pooled": check(mx, oq.providers_pooled),
        "gender_distribution": check(mx, oq.gender),
        "age_distribution": check(ages, oq.age),
        "event_demo_distribution": check(ages, oq.event_demo),
        "state_distribution": shares(mx, oq.state_counts(mx), "patient_state"),
        "event_state_distribution": shares(mx, oq.event_state_counts(mx), "patient_state"),
        "provider_distribution": mx.ctes() + "select id_column, k as id, n, round("
                                 + oq.pct("n", "total") + f", 4) as share from ({provider_tops})",
        "cohort_distribution": shares(mx, oq.cohort_counts(mx), "cohort", "p",
                                      "o as n_entities, "),
        "patient_overlap": check(span, oq.entity_family, "patient_overlap",
                                 metric="overlap_percentage"),
        "new_patients_overlap": check(span, oq.entity_family, "patient_overlap",
                                      metric="new_patients_percentage"),
        "new_patients": check(span, oq.entity_family, "new_patients"),
        "patient_retention": check(span, oq.entity_family, "patient_retention"),
        "medication_changes": check(span, oq.shifts),
        "medication_changes_v4": check(span, oq.shifts_v4),
        "patient_counts_returning": check(
            span, oq.entity_family, "patient_count", "overlapping_patients", "appearing_patients",
            "returning_patients"),
        "volume_counts": check(span, oq.volume_counts),
        "record_count": check(span, oq.volume_totals, "record_count"),
        "patient_count": check(span, oq.volume_totals, "patient_count"),
        "code_count": check(span, oq.volume_totals, "code_count"),
        "provider_metrics": check(span, oq.volume_totals, "provider_metrics"),
        "organization_metrics": check(span, oq.volume_totals, "organization_metrics"),
        "payer_metrics": check(span, oq.volume_totals, "payer_metrics"),
        "cohort_metrics": check(span, oq.volume_totals, "cohort_metrics"),
        "volume_change": check(span, oq.volume_totals, metric="change_percentage"),
        "cohort_patients_change": check(span, oq.volume_totals, "cohort_metrics",
                                        metric="patients_with_cohort_change_percentage"),
        "avg_patients_per_provider": check(span, oq.averages, metric="avg_patients"),
        "avg_patients_change": check(span, oq.averages, metric="avg_patients_change_percentage"),
        "top_providers": by_month(tops, "role, k as id, p as n"),
        "top_providers_change": by_month(
            tops, f"role, k as id, p as n, q as n_previous, round({oq.chg('p', 'q')}, 4) "
            f"as change_pct"),
        "cohort_patients_topn": by_month(cohort_top, "k as cohort, n, p as n_entities"),
        "cohort_shifts": check(span, oq.cohort_shifts),
        "cohort_shifts_v4": check(span, oq.cohort_shifts_v4),
        "volume_empty": "select check_name, metric_name, cast(null as bigint) as num, "
                        "cast(null as bigint) as den, cast(null as double) as value, status from "
                        "(values ('data_loading', 'source_data', 'WARN'), ('payer_metrics', "
                        "'status', 'INFO'), ('cohort_metrics', 'status', 'INFO')) t(check_name, "
                        "metric_name, status) where (check_name <> 'data_loading' or not exists "
                        f"(select 1 from ({cv.oracle_view('rx_events')}) where kh_refresh_date >= "
                        f"{empty} and kh_refresh_date < {empty} + interval 1 month))",
    }


__all__ = ["entry", "oracle_sql", "queries"]
