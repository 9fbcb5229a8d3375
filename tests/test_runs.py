"""Suites, backfills, history, joins and plans."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import day
from pyspark.sql import functions as F

from refreshguard.functions import months
from refreshguard.functions.formats import RESULT_SCHEMA, new_run, to_results
from refreshguard.operators import consistency, generic, intervals, marks, pairs, snapshots
from refreshguard.operators.intervals import merge
from refreshguard.operators.joins import join_intervals
from refreshguard.operators.shared import SharedFrames, entity_days
from refreshguard.plans import backfill, state, suite
from refreshguard.sources import history, tables

START = datetime(2024, 5, 1, 10, 0, 0)
REFRESH = day("2024-03-10")


@pytest.fixture(scope="module")
def several(events, context):
    """Events of 2024-01, -02, -04 and -05 (nothing in March) with all dimensions."""
    rng = random.Random(7)
    rows = []
    for month in ("2024-01", "2024-02", "2024-04", "2024-05"):
        for i in range(60):
            first = day(f"{month}-01") - timedelta(days=rng.randint(0, 90))
            rows.append({
                "medical_event_id": rng.randint(0, 150),
                "kh_refresh_date": day(f"{month}-{i % 28 + 1:02d}"),
                "patient_id": rng.choice([None, *range(12)]), "service_date": first,
                "service_to_date": first + timedelta(days=rng.randint(-3, 3)),
                "procedure_code": rng.choice([None, "P1", "P2"]), "procedure_code_type": "CPT",
                "billing_npi": rng.choice(["1000000000", "2000000000", "x"]),
                "rendering_npi": rng.choice([None, "1000000000", "3000000000"]),
                "units": float(rng.randint(-1, 3)), "unit_type": "UN",
                "ndc11": rng.choice([None, "n1", "n2"]), "cohort_id": rng.choice(["a", "b", None]),
                "mx_cohort": rng.choice(["u", "v"]), "kh_plan_id": rng.randint(1, 3)})

    def some_day():
        return day("2023-10-01") + timedelta(days=rng.randint(0, 200))

    snapshots = [day(f"2024-{m:02d}-03") for m in range(1, 6)]
    demo, dead, enroll, geo = [], [], [], []
    for p in range(10):
        for refresh in rng.sample(snapshots, 2):
            demo.append((p, refresh, rng.choice(["f", "m", None]), rng.choice([None, 1950, 2015])))
            if p % 3 == 0:
                dead.append((p, refresh, rng.choice([None, some_day()])))
        for _ in range(3):
            a, b = some_day(), some_day()
            enroll.append((p, rng.choice(snapshots), a, b))
            geo.append((p, rng.choice(snapshots), a, b, rng.choice(["A", "B"])))
    dims = {"demo": demo, "mortality": dead, "enroll": enroll, "geo": geo,
            "providers": [("1000000000", snapshots[0]), ("3000000000", snapshots[3])]}

    def make(**changes):
        return context(events(*rows), dimensions=dims, **changes)
    return make


def plain(frame, *extra):
    names = ["check_category", "check_name", "metric_name", "num", "den", "value", "metric_value",
             "status", *extra]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


@pytest.mark.parametrize("snapshot", ["upto", "exact"])
def test_backfill_equals_single_months(several, snapshot):
    ctx = several(snapshot=snapshot)
    together = backfill.backfill_metrics(ctx, "2024-01", "2024-05").cache()
    for month in ("2024-02", "2024-03", "2024-04"):
        alone = ctx.with_(month=month, previous=months.shift(month, -1))
        mine = together.filter(months.label(together.month) == month)
        assert plain(mine) == plain(suite.suite_metrics(alone)), month


def test_families_add_up_to_the_suite(several):
    ctx = several(month="2024-02", previous="2024-01")
    whole = plain(suite.suite_metrics(ctx))
    parts = [r for f in suite.FAMILIES for r in plain(suite.family_frame(ctx, f))]
    assert whole == sorted(parts, key=repr)


def test_no_previous_month_skips_only_the_comparison(several):
    ctx = several(month="2024-01", previous=None)
    rows = suite.suite_metrics(ctx, ["temporal", "volume"])
    assert [r.metric_value for r in rows.filter("check_category = 'temporal'").collect()] == [
        "SKIPPED"]
    together = backfill.backfill_metrics(several(), "2024-01", "2024-03", ["volume"])
    first = together.filter(months.label(together.month) == "2024-01")
    mine = plain(rows.filter("check_category = 'volume'"))
    assert mine and mine == plain(first)


def test_a_metric_has_one_row(several):
    """Category, check and metric name a row of a month, but for top ids, which name themselves."""
    rows = backfill.backfill_metrics(several(), "2024-01", "2024-03")
    counts = rows.groupBy("month", "check_category", "check_name", "metric_name").count()
    assert counts.filter("count > 1").collect() == []


def test_a_sample_is_the_same_everywhere(several):
    ctx = several(month="2024-02", previous="2024-01", sample_rows=3)
    ids = {r[0] for r in ctx.events().select("medical_event_id").collect()}
    assert len(ids) == 3
    now = ctx.compared().filter(months.in_months(F.col("kh_refresh_date"), ctx.month))
    assert {r[0] for r in now.select("medical_event_id").collect()} == ids


def test_unknown_family_is_refused():
    with pytest.raises(ValueError, match="consistency,"):
        suite.select_families(["completeness", "consistency,"])
    assert suite.select_families(["all"]) == list(suite.FAMILIES)


def test_a_family_that_cannot_be_planned_is_an_error_row(several):
    ctx = several(month="2024-02")
    ctx = ctx.with_(dimensions={k: v for k, v in ctx.dimensions.items() if k != "geo"})
    rows = suite.suite_metrics(ctx, ["uniqueness", "distribution"]).collect()
    errors = [r for r in rows if r.metric_value == "ERROR"]
    assert [(r.check_category, r.status) for r in errors] == [("distribution", "FAIL")]
    assert any(r.check_category == "uniqueness" for r in rows)


def test_a_family_that_fails_at_run_time_is_isolated(several, spark, tmp_path):
    ctx = several(month="2024-02")
    broken = ctx.events_table.withColumn("units", ctx.events_table.kh_plan_id.cast("string"))
    broken = broken.selectExpr("* except (units)", "cast(concat(units, 'x') as double) as units")
    target = str(tmp_path / "history")
    done = suite.run_suite([ctx.with_(events_table=broken)], target, "r1", START,
                           ["uniqueness", "validity"])
    assert done == {("mx_events", "uniqueness"): "done", ("mx_events", "validity"): "failed"}
    rows = history.read_history(spark, target).collect()
    assert [r.check_category for r in rows if r.metric_value == "ERROR"] == ["validity"]
    assert any(r.check_category == "uniqueness" for r in rows)


def test_persisted_slice_gives_the_same_rows(several, spark, tmp_path):
    ctx = several(month="2024-02", previous="2024-01")
    found = []
    for keep in (False, True):
        target = str(tmp_path / f"history{keep}")
        suite.run_suite([ctx], target, "r", START, ["uniqueness", "temporal"], persist=keep)
        found.append(sorted(map(tuple, history.read_history(spark, target).collect()), key=repr))
    assert found[0] == found[1]


def test_missing_columns_skip(several):
    ctx = several(month="2024-02", previous="2024-01")
    bare = ctx.events_table.drop("patient_id", "service_date", "billing_npi", "rendering_npi",
                                 "referring_npi")
    rows = suite.suite_metrics(ctx.with_(events_table=bare),
                               ["distribution", "validity", "consistency"]).collect()
    skipped = {r.check_name for r in rows if r.metric_value == "SKIPPED"}
    assert skipped >= {"demographic_distribution", "state_distribution", "provider_distribution",
                       "event_state_distribution", "cohort_distribution", "future_dates",
                       "patient_demographics", "provider_ids"}
    assert not [r for r in rows if r.metric_value == "ERROR"]


def test_history(several, spark, tmp_path):
    target = str(tmp_path / "history")
    for run, start in (("r1", START), ("r2", START + timedelta(days=1))):
        backfill.run_backfill(several(), "2024-01", "2024-02", target, run, start,
                              ["uniqueness"])
    rows = history.read_history(spark, target)
    assert rows.columns == RESULT_SCHEMA.fieldNames()
    assert {(r.run_id, r.refresh_month) for r in rows.collect()} == {
        (run, m) for run in ("r1", "r2") for m in ("2024-01", "2024-02")}
    assert history.latest_run(rows).count() == rows.count() / 2
    assert history.append(None, target) is False


def test_catalog_table(several, spark):
    spark.sql("create database if not exists checks")
    several().events_table.write.mode("overwrite").saveAsTable("checks.events")
    try:
        assert tables.read_table(spark, "spark_catalog", "checks", "events").count() == 240
        with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
            tables.read_table(spark, "spark_catalog", "checks", "absent").count()
    finally:
        spark.sql("drop table checks.events")


def test_history_in_tables(several, spark):
    ctx = several(month="2024-02")
    rows = to_results(suite.family_frame(ctx, "uniqueness"), "r", START, "t", "2024-02")
    spark.sql("create database if not exists checks")
    flat = rows.limit(0).write.mode("overwrite")
    flat.saveAsTable("checks.flat")
    spark.sql("drop table if exists checks.split")
    try:
        for target in ("checks.flat", "checks.split"):
            for _ in range(2):
                history.append(rows, target)
            found = history.read_history(spark, target)
            assert found.columns == RESULT_SCHEMA.fieldNames()
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(
                list(map(tuple, rows.collect())) * 2, key=repr)
    finally:
        spark.sql("drop table if exists checks.flat")
        spark.sql("drop table if exists checks.split")


def test_combine_leaves_out_what_does_not_fit(several, spark):
    ctx = several(month="2024-02")
    good = to_results(suite.family_frame(ctx, "uniqueness"), "r", START, "t", "2024-02")
    both = history.combine([None, good, spark.range(3), history.empty_results(spark),
                            good.select(*reversed(good.columns))])
    assert both.count() == 2 * good.count()
    assert history.combine([None]) is None


def test_signed_notation(several):
    ctx = several(month="2024-03", previous="2024-02")
    rows = to_results(suite.suite_metrics(ctx, ["volume"]), "r", START, "t", "2024-03",
                      signed=True).collect()
    shown = {(r.check_name, r.metric_name): r.metric_value for r in rows}
    assert shown["record_count", "change_percentage"] == "-100.00%"
    assert shown["record_count", "current_count_rows"] == "0"


def test_months(several, events):
    table = several().events_table
    assert tables.resolve_months(table, "kh_refresh_date") == ("2024-05", "2024-04")
    april = tables.previous_month(table, "kh_refresh_date", "2024-04").first()
    assert april.previous_month is None
    assert tables.resolve_months(table.limit(0), "kh_refresh_date") == (None, None)
    assert months.shift("2024-01", -1) == "2023-12"
    assert tables.sample(table, 7).count() == 7


def test_run_identity():
    run_id, start = new_run()
    assert run_id.startswith(f"{start:%Y%m%d_%H%M%S}_") and len(run_id.split("_")[-1]) == 8


def test_own_checks(several, metric):
    ctx = several(month="2024-02", previous="2024-01")
    checks = {
        "nulls": generic.null_percent(["ndc11"]),
        "rules": generic.predicate_percent({"no_units": "units <= 0"}, "FAIL"),
        "allowed": generic.allowed_values("mx_cohort", ["u"]),
        "keys": generic.foreign_key_missing("billing_npi", "providers", "npi"),
        "intervals": generic.interval_unmatched("enroll", "start_date", "end_date"),
        "top": generic.top_share_rows("mx_cohort", 1),
        "change": generic.month_change("moved", "units > 0", 0.1)}
    found = suite.suite_metrics(ctx, ["uniqueness"], checks).cache()
    assert {r.check_category for r in found.collect()} == {"uniqueness", "custom"}
    assert metric(found, "billing_npi_in_providers", "missing_percent").den == 3
    outside = metric(found, "outside_enroll", "outside_percent")
    from refreshguard.operators import consistency
    same = metric(consistency.outside_enrollment(ctx), "enrollment_periods",
                  "outside_enrollment_percent")
    assert (outside.num, outside.den) == (same.num, same.den)
    alone = [r for check in checks.values() for r in check(ctx).collect()]
    together = found.filter("check_category = 'custom'").collect()
    assert sorted(map(tuple, alone), key=repr) == sorted(map(tuple, together), key=repr)


def event_scans(frame):
    """How often a plan reads the events, reused exchanges not counted."""
    plan = plan_of(frame)
    return sum("medical_event_id" in line for line in plan.split("\n") if "ExistingRDD" in line)


def test_own_checks_share_the_passes_of_the_suite(several):
    ctx = several(month="2024-02", previous="2024-01")
    scans = {"nulls": generic.null_percent(["ndc11"]),
             "rules": generic.predicate_percent({"no_units": "units <= 0", "null_ndc11": "true"}),
             "allowed": generic.allowed_values("mx_cohort", ["u"])}
    changes = {n: generic.month_change(n, f"units > {k}", 0.1) for k, n in enumerate("abc")}
    assert event_scans(suite.suite_metrics(ctx, ["validity"], scans)) == 1
    assert event_scans(suite.suite_metrics(ctx, [], changes)) == 1
    assert event_scans(suite.suite_metrics(ctx, ["validity"], scans | changes)) == 2


def test_stored_reductions_give_the_same_rows_from_fewer_scans(several):
    ctx = backfill.over_months(several(), "2024-01", "2024-05")
    families = ["consistency", "distribution", "temporal", "volume"]
    lazy, kept = (suite.suite_metrics(ctx, families, keep=k) for k in (False, True))
    assert plain(lazy, "month") == plain(kept, "month")
    assert event_scans(kept) < event_scans(lazy)
    # Left to the final plan: dates in order, two joins of event ids, and cohorts; plans as first made
    # show a reused part each time.
    assert event_scans(kept) <= 6


# -- joins -------------------------------------------------------------------------

def test_a_hot_entity_meets_its_intervals(several, spark):
    """One entity with nearly all events; null entities meet nothing."""
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1, 1, 1, 1, 2]), day("2024-03-01") + timedelta(days=i % 28))
            for i in range(300)]
    events = spark.createDataFrame(rows, "medical_event_id long, patient_id long, service_date date"
                                   ).withColumn("kh_refresh_date", F.lit(day("2024-03-01")))
    spans = [(1, day("2024-03-03"), day("2024-03-09")), (1, day("2024-03-05"), day("2024-03-12")),
             (2, day("2024-03-20"), day("2024-03-19"))]
    table = spark.createDataFrame(spans, "entity long, first_day date, last_day date")
    ctx = several(month="2024-03", previous=None).with_(events_table=events)
    out = join_intervals(ctx, SharedFrames(ctx), table, "left_anti")
    inside = {i for i, p, d in rows if any(p == e and a <= d <= b for e, a, b in spans)}
    assert sorted(r.event_id for r in out.collect()) == sorted({r[0] for r in rows} - inside)


def test_merged_intervals_cover_the_same_days(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(60):
        a = day("2024-01-01") + timedelta(days=rng.randint(0, 120))
        rows.append((rng.randint(1, 4), a, a + timedelta(days=rng.randint(-2, 9))))
    table = spark.createDataFrame(rows, "k long, first_day date, last_day date")
    merged = merge(table, ["k"]).collect()

    def days(found):
        return [(k, a + timedelta(days=i)) for k, a, b in found for i in range((b - a).days + 1)]
    assert sorted(days(map(tuple, merged))) == sorted(set(days(rows)))


@pytest.mark.parametrize("block", [120, 2])
def test_intervals_of_months_are_not_repeated(several, monkeypatch, block):
    """Each month is what it is alone; the rows before the window are those of a single month's day and edge rows."""
    monkeypatch.setattr(intervals, "MONTHS", block)
    ctx = backfill.over_months(several(), "2024-01", "2024-05")
    days, regions = entity_days(ctx), snapshots.regions(ctx)
    together = intervals.region_counts(ctx, days, regions).collect()
    outside = {str(r.month)[:7]: (r.n, r.n_outside) for r in
               intervals.uncovered(ctx, days, snapshots.enrollment(ctx)).collect()}
    for month in ("2024-01", "2024-02", "2024-03", "2024-04", "2024-05"):
        alone = several(month=month, previous=None)
        mine = intervals.region_counts(alone, entity_days(alone), snapshots.regions(alone))
        assert sorted((r.region or "", r.n) for r in mine.collect()) == sorted(
            (r.region or "", r.n) for r in together if str(r.month)[:7] == month)
        one = intervals.uncovered(alone, entity_days(alone), snapshots.enrollment(alone)).first()
        assert outside[month] == (one.n, one.n_outside)
    if block == 120:
        rows = intervals.accumulated(ctx, days, regions).count()
        assert rows == days.count() + intervals.edge_days(
            regions, ["month", "entity", "region"]).count()


# -- plans -------------------------------------------------------------------------

def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_month_filter_reaches_the_scan(several, spark, tmp_path):
    path = str(tmp_path / "events")
    several().events_table.write.parquet(path)
    ctx = several(month="2024-02").with_(events_table=tables.read_parquet(spark, path))
    text = plan_of(suite.family_frame(ctx, "validity"))
    assert "GreaterThanOrEqual(kh_refresh_date,2024-02-01)" in text
    assert "LessThan(kh_refresh_date,2024-03-01)" in text
    assert "cohort_id" not in text.split("ReadSchema")[1]


def test_single_pass_families_shuffle_once(several):
    text = plan_of(suite.family_frame(several(month="2024-02"), "validity"))
    assert text.count("Exchange") == 1


def test_no_cross_join_and_no_python(several):
    for frame in (suite.suite_metrics(several(month="2024-02", previous="2024-01")),
                  backfill.backfill_metrics(several(), "2024-01", "2024-03")):
        text = plan_of(frame)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert word not in text


def test_months_kept_as_state_compare_like_a_backfill(several, spark, tmp_path):
    path = str(tmp_path / "state")
    together = backfill.backfill_metrics(several(), "2024-01", "2024-05", suite.COMPARING).cache()
    for month in ("2024-01", "2024-02", "2024-03", "2024-04", "2024-05"):
        # Only the month's own events are there; the month before is known by its state alone.
        ctx = several(month=month, previous=months.shift(month, -1))
        ctx = ctx.with_(events_table=ctx.events().cache())
        mine = state.advance(ctx, path)
        assert event_scans(mine) == 0
        assert plain(mine) == plain(together.filter(months.label(together.month) == month)), month
    whole = str(tmp_path / "whole")
    ctx = backfill.over_months(several(), "2024-01", "2024-05")
    state.save(ctx, whole)
    first = plain(state.compare(ctx, whole), "month")
    assert first == plain(together, "month")
    state.save(several(month="2024-02"), whole)  # the same month again
    assert plain(state.compare(ctx, whole), "month") == first
    with pytest.raises(ValueError, match="by month"):
        state.save(several(scope="all"), whole)


BAD = "2024-04"


def unreadable(ctx, month=BAD):
    """The context, with a month whose rows fail when any of their values is read."""
    table = ctx.events_table
    fail = f"trunc(kh_refresh_date, 'MM') = date'{month}-01'"
    columns = [c if c == "kh_refresh_date" else
               f"if({fail}, cast(raise_error('unreadable') as {t}), {c}) as {c}"
               for c, t in table.dtypes]
    return ctx.with_(events_table=table.selectExpr(*columns))


def by_month(frame):
    rows = {}
    for r in frame.collect():
        rows.setdefault(r.refresh_month, []).append(
            (r.check_category, r.check_name, r.metric_name, r.metric_value, r.status))
    return {m: sorted(v, key=repr) for m, v in rows.items()}


def test_an_unreadable_month_costs_only_itself(several, spark, tmp_path):
    """Each month of the range is what its own run gives, ERROR rows included."""
    families = ["completeness", "uniqueness", "temporal"]
    bad = unreadable(several())
    target = str(tmp_path / "range")
    outcome = backfill.run_backfill(bad, "2024-01", "2024-05", target, "r", START, families)
    assert set(outcome.values()) == {"partial"}
    found = by_month(history.read_history(spark, target))
    assert sorted(found) == [f"2024-0{m}" for m in range(1, 6)]
    for month in found:
        alone = str(tmp_path / month)
        backfill.run_backfill(bad, month, month, alone, "r", START, families)
        assert by_month(history.read_history(spark, alone)) == {month: found[month]}
    whole = str(tmp_path / "whole")
    backfill.run_backfill(several(), "2024-01", "2024-05", whole, "r", START, families)
    good = by_month(history.read_history(spark, whole))
    assert sorted(m for m in good if good[m] == found[m]) == ["2024-01", "2024-02", "2024-03"]
    errors = {m: {r[0] for r in rows if r[3] == "ERROR"} for m, rows in found.items()}
    # May cannot be compared with April; its own counts are there.
    assert errors == {"2024-01": set(), "2024-02": set(), "2024-03": set(), BAD: set(families),
                      "2024-05": {"temporal"}}


def test_a_run_committed_twice_has_its_rows_once(several, spark, tmp_path):
    target = str(tmp_path / "history")
    ctx = several(month="2024-02", previous="2024-01")
    families = ["completeness", "uniqueness"]

    def run(run_id, names, context=ctx):
        return suite.run_suite([context], target, run_id, START, names, once=True)

    def rows():
        return sorted(map(tuple, history.read_committed(spark, target).collect()), key=repr)

    assert set(run("r1", families).values()) == {"done"}
    first = rows()
    assert {r[4] for r in first} == set(families)
    assert set(run("r1", families).values()) == {"done"} and rows() == first
    run("r1", [*families, "validity"])
    more = rows()
    assert {r[4] for r in more} == {*families, "validity"} and set(first) < set(more)
    run("r2", families)
    assert len(rows()) == len(more) + len(first)
    # A part that was begun and not finished is not read, and is written anew.
    history._mark(spark, target, [("r1", "mx_events", "validity")], history.OPEN, {})
    assert len(rows()) == 2 * len(first)
    run("r1", ["validity"])
    assert len(rows()) == len(more) + len(first)


def test_committing_replaces_errors_of_an_earlier_attempt(several, spark, tmp_path):
    target = str(tmp_path / "history")
    ctx = several(month="2024-02", previous="2024-01")
    results = to_results(suite.error_row(ctx, "uniqueness", ValueError("x")), "r", START,
                         "mx_events", "2024-02")
    history.commit(results, target, "r", "mx_events", ["uniqueness"])
    assert history.read_committed(spark, target).count() == 1
    good = to_results(suite.family_frame(ctx, "uniqueness"), "r", START, "mx_events", "2024-02")
    history.commit(good, target, "r", "mx_events", ["uniqueness"])
    found = history.read_committed(spark, target)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, good.collect()))
    history.commit(good.limit(0), target, "r", "mx_events", ["uniqueness"])
    assert history.read_committed(spark, target).count() == 0
    assert history.finished(spark, target, "r") == {("mx_events", "uniqueness")}
    assert history.finished(spark, str(tmp_path / "none"), "r") == set()


def test_ids_are_counted_by_month_before_they_are_paired(several, spark, tmp_path):
    """State has a row per month, role and id, and what is paired carries no entity."""
    path = str(tmp_path / "state")
    ctx = backfill.over_months(several(), "2024-01", "2024-05")
    state.save(ctx, path)
    ids = spark.read.parquet(f"{path}/{state.IDS}")
    assert ids.groupBy("own", "role", "id").count().filter("count > 1").isEmpty()
    roles = ["provider", "cohort"]
    lines = plan_of(pairs.role_ids(ctx, roles)).split("\n")
    twice = next(k for k, line in enumerate(lines) if "Generate inline(array(" in line
                 and "in_prev" in line)
    assert any("HashAggregate" in line and "count(entity" in line for line in lines[twice:])


def test_a_backfill_over_stored_reductions_gives_the_same_rows(several):
    lazy = backfill.backfill_metrics(several(), "2024-01", "2024-05", suite.COMPARING)
    kept = backfill.backfill_metrics(several(), "2024-01", "2024-05", suite.COMPARING, keep=True)
    assert plain(kept, "month") == plain(lazy, "month")
    assert event_scans(kept) < event_scans(lazy)


def test_days_of_long_ranges_carry_few_totals(several):
    ctx = backfill.over_months(several(), "2020-01", "2026-08")
    parts = intervals.blocks(ctx)
    assert max(months.months_between(p.start, p.month) for p in parts) <= 16
    assert sum(months.months_between(p.start, p.month) for p in parts) == 80


@pytest.fixture(scope="module")
def marked(spark, several):
    """Days and intervals of odd kinds over three months, and what each event meets."""
    rng = random.Random(11)
    labels = ("2024-01", "2024-02", "2024-03")

    def some_day():
        return day("2024-01-01") + timedelta(days=rng.randint(0, 30))

    rows = [(rng.choice([None, *range(60)]), rng.choice([None, 1, 1, 1, 2, 3]),
             rng.choice([None, *(some_day() for _ in range(9))]),
             day(f"{rng.choice(labels)}-05")) for _ in range(240)]
    events = spark.createDataFrame(
        rows, "medical_event_id long, patient_id long, service_date date, kh_refresh_date date")
    spans = [(rng.choice([None, 1, 1, 2]), some_day(), some_day(), rng.choice(["A", "B", None]))
             for _ in range(12)]
    # Snapshots that say the same again, twice in one of them, and one that is later than all months.
    geo = [(p, day(f"2024-{m:02d}-0{k}"), a, b, r) for m in (2, 3, 4) for k in (1, 2)
           for p, a, b, r in spans if rng.random() < 0.6]
    dims = {"geo": geo, "enroll": [g[:4] for g in geo[::3]],
            "mortality": [(p, day(f"2024-{m:02d}-02"), some_day()) for p in (1, 2) for m in (1, 3)]}
    base = several()
    tables = {name: spark.createDataFrame(dims[name], base.dimensions[name].schema)
              if name in dims else table for name, table in base.dimensions.items()}
    ctx = backfill.over_months(base.with_(events_table=events, dimensions=tables), *labels[::2])
    return ctx, rows, dims, labels


def seen_in(table, label):
    """The complete, not reversed intervals that a month sees: entity, first and last day, region."""
    return [(r[0], r[2], r[3], *r[4:]) for r in table if f"{r[1]}"[:7] <= label and r[0] is not None
            and None not in r[2:] and r[2] <= r[3]]


def test_marked_days_say_what_pairs_of_events_and_intervals_say(marked):
    ctx, rows, dims, labels = marked
    shared = SharedFrames(ctx, True, [marks.ENROLLED, marks.REGIONS])
    outside = {f"{r.month}"[:7]: (r.n, r.n_outside) for r in shared.uncovered().collect()}
    regions = {(f"{r.month}"[:7], r.region): r.n for r in shared.region_counts().collect()}
    ids = {f"{r.month}"[:7]: r.n for r in shared.marked_ids(marks.ENROLLED).collect()}
    region_ids = {(f"{r.month}"[:7], r.region): r.n for r in shared.marked_ids(marks.REGIONS).collect()}
    places, place_ids = {}, {}
    for label in labels:
        mine = [r for r in rows if f"{r[3]}"[:7] == label]
        enrolled, geo = seen_in(dims["enroll"], label), seen_in(dims["geo"], label)

        def holding(table, r):
            return [s for s in table if r[2] is not None and s[0] == r[1] and s[1] <= r[2] <= s[2]]

        off = [r for r in mine if not holding(enrolled, r)]
        assert outside[label] == (len(mine), len(off))
        assert ids[label] == len({r[0] for r in off})
        for r in mine:
            for region in [s[3] for s in holding(geo, r)] or [None]:
                places[label, region] = places.get((label, region), 0) + 1
                if region:
                    place_ids.setdefault((label, region), set()).add(r[0])
    assert regions == places
    assert region_ids == {k: len(v) for k, v in place_ids.items()}


def test_marks_of_one_dimension_are_those_of_both(marked):
    ctx = marked[0]
    both, alone = SharedFrames(ctx, True, [marks.ENROLLED, marks.REGIONS]), SharedFrames(ctx, True)
    for kind in (marks.ENROLLED, marks.REGIONS):
        for found in ("marks", "marked_ids"):
            mine, theirs = (getattr(s, found)(kind).collect() for s in (both, alone))
            assert sorted(map(repr, mine)) == sorted(map(repr, theirs))


def test_a_death_counts_until_the_next_one(marked, several):
    ctx, rows, dims, labels = marked
    found = {(f"{r.month}"[:7], r.metric_name): (r.num, r.den)
             for r in consistency.after_death(ctx, grace_days=3).collect()}
    for label in labels:
        latest = {}
        for p, refresh, death in sorted(dims["mortality"]):
            if f"{refresh}"[:7] <= label:
                latest[p] = death
        dead = [(r[2], latest[r[1]]) for r in rows if f"{r[3]}"[:7] == label and r[1] in latest]
        late = sum(d is not None and d > e + timedelta(days=3) for d, e in dead)
        after = sum(d is not None and d > e for d, e in dead)
        assert found[label, "after_death_percent"] == (late, len(dead))
        assert found[label, "after_death_count"] == (after, len(dead))


def test_stored_reductions_carry_no_totals_of_months(several):
    """Days are shuffled by entity once for the intervals, without a running total for each month."""
    ctx = backfill.over_months(several(), "2024-01", "2024-05")
    kept = suite.suite_metrics(ctx, ["consistency", "distribution"], keep=True)
    assert "slice(" not in plan_of(kept)
    assert event_scans(kept) <= 3  # dates in order, and cohorts, which a plan as first made shows twice


def test_a_broken_dimension_costs_only_its_family(several, spark, tmp_path):
    """Marks of both dimensions are one pass; it fails, and each family is tried by itself."""
    ctx = backfill.over_months(several(), "2024-01", "2024-02")
    broken = ctx.dimensions["geo"].withColumn(
        "patient_state", F.expr("cast(raise_error('unreadable') as string)"))
    ctx = ctx.with_(dimensions={**ctx.dimensions, "geo": broken})
    outcome = suite.run_suite([ctx], str(tmp_path / "out"), "r", START,
                              ["consistency", "distribution"], keep=True)
    assert outcome == {("mx_events", "consistency"): "done", ("mx_events", "distribution"): "failed"}
