"""Edge semantics on literal rows."""

from __future__ import annotations

import dataclasses

from conftest import day

from refreshguard import MEDICAL, PHARMACY, Thresholds
from refreshguard.operators import (completeness, consistency, distribution, temporal, uniqueness,
                                    validity, volume)

FEB = {"kh_refresh_date": day("2024-02-05")}
REFRESH = day("2024-03-10")


# -- completeness and uniqueness -------------------------------------------

def test_null_percent_at_the_threshold_passes(events, context, metric):
    rows = [{"medical_event_id": i, "units": None if i == 0 else 1.0} for i in range(20)]
    found = completeness.completeness(context(events(*rows)))
    at = metric(found, "optional_fields", "units_null_percentage")
    assert (at.num, at.value, at.status) == (1, 5.0, "PASS")
    above = completeness.completeness(context(events(*rows[:19])))
    assert metric(above, "optional_fields", "units_null_percentage").status == "WARN"


def test_required_null_fails_and_empty_month_informs(events, context, metric):
    table = events({"patient_id": None}, {})
    found = completeness.completeness(context(table))
    assert metric(found, "required_fields", "patient_id_null_percentage").status == "FAIL"
    assert metric(found, "required_fields", "patient_id_null_count").metric_value == "1"
    empty = completeness.completeness(context(table, month="2023-01"))
    row = metric(empty, "required_fields", "patient_id_null_percentage")
    assert (row.value, row.status) == (0.0, "PASS")
    assert metric(empty, "required_fields", "patient_id_null_count").status == "INFO"


def test_missing_columns(events, context, metric):
    table = events({}).drop("billing_npi", "units")
    found = completeness.completeness(context(table))
    row = metric(found, "required_fields", "billing_npi_not_found")
    assert (row.metric_value, row.status) == ("0", "WARN")
    names = {r.metric_name for r in found.collect()}
    assert "units_null_percentage" not in names
    from refreshguard.operators.scan import run_scan
    told = run_scan(context(table), completeness.optional_checks(context(table), True))
    assert metric(told, "optional_fields", "units_null_percentage").metric_value == "SKIPPED"


def test_code_type_without_code(events, context, metric):
    table = events({"procedure_code_type": "CPT"}, {"procedure_code": "P1"}, {})
    row = metric(completeness.completeness(context(table)), "procedure_code_type_consistency",
                 "inconsistent_count")
    assert (row.num, row.status) == (1, "WARN")


def test_null_is_a_key_of_its_own(events, context, metric):
    table = events({"medical_event_id": 1}, {"medical_event_id": 1}, {"medical_event_id": None},
                   {"medical_event_id": None})
    found = uniqueness.uniqueness(context(table))
    share = metric(found, "primary_key_uniqueness", "medical_event_id_duplicate_percentage")
    keys = metric(found, "primary_key_uniqueness", "medical_event_id_duplicate_keys")
    assert (share.num, share.value, keys.num) == (2, 50.0, 2)
    groups = metric(found, "duplicate_records", "duplicate_record_percentage")
    assert (groups.num, groups.value, groups.status) == (1, 25.0, "WARN")


def test_uniqueness_without_its_columns(events, context, metric):
    table = events({}).drop("medical_event_id", "procedure_code")
    found = uniqueness.uniqueness(context(table))
    assert metric(found, "primary_key_uniqueness", "status").metric_value == "SKIPPED"
    assert metric(found, "duplicate_records", "status").metric_value == "SKIPPED"


# -- validity ----------------------------------------------------------------

def test_validity_rules(events, context, metric):
    table = events(
        {"service_date": day("2024-04-02"), "ndc11": "12345-6789-01", "units": 0.0},
        {"service_date": day("1899-12-31"), "ndc11": "12345-678-01", "units": 9999.0},
        {"billing_npi": "123456789", "rendering_npi": "12345678X0", "units": 10000.0},
        {"billing_npi": "1234567890", "procedure_code_type": "cpt", "unit_type": "other"},
        {"procedure_code_type": "local", "unit_type": "box",
         "service_to_date": day("2024-04-02")})
    found = validity.validity(context(table))
    expected = {"future_date": (1, "FAIL"), "old_date": (1, "WARN"), "invalid_ndc": (1, "WARN"),
                "negative_units": (1, "FAIL"), "extreme_units": (1, "WARN"),
                "invalid_proc_type": (1, "WARN"), "invalid_unit_type": (1, "WARN"),
                "invalid_billing_npi": (1, "WARN"), "invalid_rendering_npi": (1, "WARN"),
                "invalid_referring_npi": (0, "PASS"), "future_service_to_date": (1, "FAIL")}
    rows = {r.metric_name: r for r in found.collect()}
    assert {k: (rows[f"{k}_percent"].num, rows[f"{k}_percent"].status)
            for k in expected} == expected
    assert rows["old_date_percent"].value == 20.0
    assert rows["old_date_count"].metric_value == "1"
    assert "status" not in rows


def test_unfolded_allow_list_rejects_mixed_case(events, context, metric):
    table = events({"unit_type": "Other"}, {"unit_type": "UN"})
    folded = validity.validity(context(table), ["unit_type"])
    assert metric(folded, "unit_type", "invalid_unit_type_percent").num == 0
    unfolded = validity.validity(context(table, fold_allowed=False), ["unit_type"])
    assert metric(unfolded, "unit_type", "invalid_unit_type_percent").num == 1


def test_validity_of_nothing_is_one_row(events, context):
    rows = validity.validity(context(events({}), month="2023-01")).collect()
    assert [(r.check_name, r.metric_value, r.status) for r in rows] == [
        ("overall_validity", "SKIPPED", "INFO")]


def test_pharmacy_dates(spark, context, metric):
    rows = [(1, day("2024-03-05"), day("2024-03-01"), day("2024-03-02"), 0),
            (2, day("2024-03-05"), day("2024-03-01"), None, 5)]
    table = spark.createDataFrame(
        rows, "patient_id long, kh_refresh_date date, fill_date date, "
              "date_prescription_written date, days_supply int")
    ctx = context(table, PHARMACY)
    found = validity.validity(ctx)
    assert metric(found, "fill_date_order", "invalid_order_percent").status == "WARN"
    assert metric(found, "days_supply_positive", "negative_days_percent").num == 1
    order = consistency.date_order(ctx)
    assert metric(order, "fill_date_order", "invalid_date_percent").value == 50.0


# -- consistency ---------------------------------------------------------------

def test_null_entity_is_missing(events, context, metric):
    table = events({"patient_id": None}, {"patient_id": 1}, {"patient_id": 2})
    demo = [(1, REFRESH, "f", 1950), (2, day("2024-02-01"), "m", 1950),
            (None, REFRESH, "f", 1950)]
    for snapshot, missing in (("upto", 1), ("exact", 2)):
        ctx = context(table, dimensions={"demo": demo}, snapshot=snapshot)
        row = metric(consistency.missing_entities(ctx), "patient_demographics",
                     "missing_patient_percent")
        assert (row.num, row.den) == (missing, 3)


def test_interval_bounds_are_inclusive(events, context, metric):
    rows = [{"medical_event_id": i, "service_date": day(d)} for i, d in enumerate(
        ["2024-01-01", "2024-01-31", "2023-12-31", "2024-02-01", "2024-01-15"])]
    rows.append({"medical_event_id": 9, "patient_id": None})
    enroll = [(1, REFRESH, day("2024-01-01"), day("2024-01-31")),
              (1, REFRESH, day("2024-01-10"), day("2024-01-20")),
              (1, REFRESH, day("2024-03-31"), day("2024-03-01")),
              (1, REFRESH, day("2024-02-01"), None), (None, REFRESH, day("2024-01-01"), REFRESH)]
    ctx = context(events(*rows), dimensions={"enroll": enroll})
    share = metric(consistency.outside_enrollment(ctx), "enrollment_periods",
                   "outside_enrollment_percent")
    ids = metric(consistency.outside_enrollment_events(ctx), "enrollment_periods",
                 "outside_enrollment_events")
    assert (share.num, share.den, ids.num) == (3, 6, 3)


def test_grace_period(events, context, metric):
    dead = [(1, REFRESH, day("2024-01-01")), (1, day("2024-01-02"), day("2020-01-01")),
            (2, REFRESH, None)]
    table = events(*[{"service_date": day(d)} for d in
                     ("2024-01-01", "2024-01-02", "2024-03-01", "2024-03-02")], {"patient_id": 2})
    found = consistency.after_death(context(table, dimensions={"mortality": dead}))
    late = metric(found, "mortality_dates", "after_death_percent")
    assert (late.num, late.den, late.status) == (1, 4, "FAIL")
    assert metric(found, "mortality_dates", "after_death_count").num == 3


def test_providers(events, context, metric):
    table = events({"billing_npi": "a", "rendering_npi": "b"},
                   {"billing_npi": "c", "rendering_npi": "c"}, {"billing_npi": "a"})
    ctx = context(table, dimensions={"providers": [("a", REFRESH)]})
    found = consistency.missing_providers(ctx)
    one = metric(found, "billing_npi_provider", "missing_npi_percent")
    other = metric(found, "rendering_npi_provider", "missing_npi_percent")
    none = metric(found, "referring_npi_provider", "missing_npi_percent")
    pool = metric(found, "provider_ids", "missing_npi_count")
    assert [(r.num, r.den) for r in (one, other, none, pool)] == [(1, 2), (2, 2), (0, 0), (2, 3)]
    nothing = consistency.missing_providers(context(events({})))
    assert metric(nothing, "provider_ids", "missing_npi_count").status == "INFO"


# -- distribution ----------------------------------------------------------------

def test_age_and_gender(events, context, metric):
    table = events(*[{"patient_id": p} for p in (1, 1, 2, 3, 4)])
    demo = [(1, day("2024-01-01"), "m", 2020), (1, REFRESH, "f", 1980), (2, REFRESH, "M", None),
            (3, REFRESH, "x", 1959)]
    found = distribution.demo_distribution(context(table, dimensions={"demo": demo}))
    assert metric(found, "gender_distribution", "share_F").num == 1
    assert metric(found, "gender_distribution", "share_other").num == 2
    ages = metric(found, "age_distribution", "distribution")
    assert ages.metric_value == "18-44: 25.0%, 65+: 25.0%, Unknown: 25.0%"
    assert (ages.den, ages.status) == (4, "WARN")
    assert metric(found, "event_gender_distribution", "share_F").num == 2
    assert metric(found, "event_age_distribution", "distribution").den == 4


def test_birth_as_date(spark, events, context, metric):
    demo = spark.createDataFrame([(1, REFRESH, "f", day("1950-06-01"))],
                                 "patient_id long, kh_refresh_date date, patient_gender string, "
                                 "patient_yob date")
    ctx = context(events({}))
    ctx = ctx.with_(dimensions=dict(ctx.dimensions) | {"demo": demo})
    assert metric(distribution.demo_distribution(ctx), "age_distribution", "share_65+").num == 1


def test_regions_multiply_and_distinct_pairs_do_not(events, context, metric):
    geo = [(1, REFRESH, day("2024-01-01"), day("2024-03-31"), "A"),
           (1, REFRESH, day("2024-02-01"), day("2024-03-31"), "A"),
           (1, REFRESH, day("2024-03-01"), day("2024-03-31"), "B")]
    table = events({"medical_event_id": 1}, {"medical_event_id": 1}, {"medical_event_id": 2},
                   {"medical_event_id": 3, "service_date": day("2023-01-01")},
                   {"medical_event_id": 4, "patient_id": None})
    ctx = context(table, dimensions={"geo": geo})
    joined = metric(distribution.region_distribution(ctx), "state_distribution",
                    "distribution")
    # A twice for each of 3 rows, B once, 2 rows in no region.
    assert joined.metric_value == "A: 54.5%, B: 27.3%, None: 18.2%"
    assert (joined.den, joined.status) == (11, "WARN")
    pairs = metric(distribution.event_region_distribution(ctx), "event_state_distribution",
                   "distribution")
    assert (pairs.metric_value, pairs.den) == ("A: 50.0%, B: 50.0%", 4)


def test_ties_are_ordered_by_key(events, context, metric):
    table = events({"billing_npi": "b"}, {"billing_npi": "a"}, {"billing_npi": "c"},
                   {"mx_cohort": "y"}, {"mx_cohort": "x"})
    ctx = context(table, thresholds=Thresholds(top_shares=2))
    row = metric(distribution.provider_distribution(ctx), "billing_npi_distribution",
                 "distribution")
    assert (row.metric_value, row.status) == ("a: 33.3%, b: 33.3%", "WARN")
    skipped = metric(distribution.provider_distribution(ctx), "referring_npi_distribution",
                     "status")
    assert skipped.metric_value == "SKIPPED"
    cohort = metric(distribution.cohort_distribution(ctx), "cohort_distribution", "distribution")
    assert cohort.metric_value == "x: 1 patients, y: 1 patients"


# -- temporal --------------------------------------------------------------------

def test_null_entity_is_new_by_anti_join_only(events, context, metric):
    table = events({"patient_id": None}, {"patient_id": 1}, {"patient_id": 2},
                   FEB | {"patient_id": 1}, FEB | {"patient_id": None})
    found = temporal.temporal(context(table))
    assert metric(found, "new_patients", "new_patients_percentage").num == 2
    assert metric(found, "patient_overlap", "new_patients_percentage").num == 1
    kept = metric(found, "patient_retention", "retention_rate")
    assert (kept.num, kept.den, kept.status) == (1, 2, "PASS")
    assert metric(found, "patient_overlap", "overlap_percentage").den == 1


def test_code_shift_minimum(events, context, metric):
    rows = [{"patient_id": i, "ndc11": "x"} for i in range(10)]
    rows += [FEB | {"patient_id": i, "ndc11": "x"} for i in range(4)]
    rows += [{"patient_id": i, "ndc11": "new"} for i in range(20)]
    found = temporal.code_shifts(context(events(*rows)))
    row = metric(found, "medication_changes", "significant_changes_count")
    assert (row.num, row.status) == (1, "WARN")
    assert "x from 4 to 10 (+6, +150.0%)" in row.details
    variant = temporal.code_shifts_by_count(context(events(*rows)))
    assert metric(variant, "medication_changes_by_count",
                  "significant_changes_count").status == "PASS"


def test_no_drug_column(events, context, metric):
    found = temporal.temporal(context(events({}).drop("ndc11")).with_(previous="2024-02"))
    rows = [r for r in found.collect() if r.check_name.startswith("medication_changes")]
    assert {r.metric_value for r in rows} == {"SKIPPED"}


def test_counts_without_previous_entities(events, context, metric):
    found = temporal.entity_counts(context(events({})))
    assert metric(found, "patient_count", "previous_month").num == 0
    assert {r.check_name for r in found.collect()} == {"patient_count"}


# -- volume ------------------------------------------------------------------------

def test_change_at_the_threshold_passes(events, context, metric):
    rows = [{"patient_id": i} for i in range(13)] + [FEB | {"patient_id": i} for i in range(10)]
    found = volume.volume(context(events(*rows)))
    row = metric(found, "patient_count", "change_percentage")
    assert (row.value, row.status) == (30.0, "PASS")
    more = volume.entity_count(context(events(*rows, {"patient_id": 99})))
    assert metric(more, "patient_count", "change_percentage").status == "WARN"


def test_no_previous_rows_is_not_applicable(events, context, metric):
    row = metric(volume.volume(context(events({}))), "record_count", "change_percentage")
    assert (row.metric_value, row.value, row.status) == ("N/A", None, "INFO")
    assert row.details == "no records in the month before"


def test_averages_and_top_ids(events, context, metric):
    rows = [{"patient_id": p, "rendering_npi": n} for p, n in
            [(1, "a"), (2, "a"), (2, "a"), (None, "b"), (3, None)]]
    rows.append(FEB | {"patient_id": 1, "rendering_npi": "a"})
    found = volume.volume(context(events(*rows)))
    average = metric(found, "provider_metrics", "avg_patients")
    assert (average.num, average.den, average.value) == (2, 2, 1.0)
    assert metric(found, "provider_metrics", "current_patients_with_provider").num == 2
    top = metric(found, "provider_patient_distribution", "provider: a")
    assert top.details == "Patient count: 2, Previous: 1, Change: +100.00%"
    assert metric(found, "provider_patient_distribution", "provider: b").num == 0


def test_cohort_shifts(events, context, metric):
    rows = [{"patient_id": i, "cohort_id": "same"} for i in range(6)]
    rows += [FEB | {"patient_id": i, "cohort_id": "same"} for i in range(5)]
    rows += [{"cohort_id": "new"}, FEB | {"cohort_id": "gone"}]
    rows += [{"patient_id": i, "cohort_id": "calm"} for i in range(6)]
    rows += [FEB | {"patient_id": i, "cohort_id": "calm"} for i in range(6)]
    found = volume.volume(context(events(*rows)))
    row = metric(found, "cohort_metrics", "cohort_distribution_changes")
    assert (row.num, row.value, row.status) == (3, 3.0, "WARN")
    by_kind = {(r.check_name, r.metric_name): (r.num, r.metric_value, r.status)
               for r in found.filter("check_name in ('cohort_shifts', 'cohort_changes')").collect()}
    assert by_kind == {("cohort_shifts", "significant_changes"): (1, "INFO", "INFO"),
                       ("cohort_changes", "new_cohorts"): (1, "1", "INFO"),
                       ("cohort_changes", "missing_cohorts"): (1, "1", "INFO")}
    shifts = {r.cohort: (r.kind, r.entities_cur, r.entities_prev, r.change_pct)
              for r in volume.cohort_shift_rows(context(events(*rows))).collect()}
    assert shifts == {"same": ("changed", 6, 5, 20.0), "new": ("new", 1, 0, None),
                      "gone": ("missing", 0, 1, -100.0), "calm": (None, 6, 6, 0.0)}


def test_many_shifted_cohorts_fill_pages(events, context, monkeypatch):
    rows = [{"cohort_id": f"new{i:03}"} for i in range(60)]
    rows += [FEB | {"cohort_id": f"gone{i:03}"} for i in range(40)]
    rows += [FEB | {"cohort_id": "calm"}, {"cohort_id": "calm"}]
    one = volume.cohort_shifts(context(events(*rows))).collect()
    monkeypatch.setattr(volume, "PAGE", 120)
    for scope in ({}, {"scope": "range", "start": "2024-02"}):
        pages = volume.cohort_shifts(context(events(*rows), **scope)).collect()
        names = [n for r in pages for part in r.details.split("; ")
                 for n in part.partition(": ")[2].split(", ")]
        assert sorted(names) == sorted(r["cohort_id"] for r in rows if r["cohort_id"] != "calm")
        first = [r for r in pages if r.metric_name == "cohort_distribution_changes"]
        assert [(r.num, r.status) for r in first] == [(r.num, r.status) for r in one]
        assert len(pages) > 4 and max(len(r.details) for r in pages) < 400
    kinds = volume.cohort_shifts_by_kind(context(events(*rows))).collect()
    assert sum(r.num for r in kinds if "part" not in r.metric_name) == 100


def test_no_shift_row_without_change_or_previous(events, context):
    calm = [{"cohort_id": "a"}, FEB | {"cohort_id": "a"}]
    for rows in (calm, [{"cohort_id": "a"}]):
        assert volume.cohort_shifts(context(events(*rows))).collect() == []
        assert volume.cohort_shifts_by_kind(context(events(*rows))).collect() == []


def test_volume_without_columns(events, context, metric):
    found = volume.volume(context(events({}).drop("patient_id")))
    assert metric(found, "data_loading", "schema_check").status == "FAIL"
    bare = events({}).drop("kh_plan_id", "procedure_code")
    rows = volume.volume(context(bare))
    assert metric(rows, "payer_metrics", "status").status == "INFO"
    assert metric(rows, "code_count", "status").status == "WARN"
    nothing = volume.volume_empty(context(events({}), month="2023-01"))
    assert metric(nothing, "data_loading", "source_data").metric_value == "EMPTY"


def test_a_profile_of_ones_own(events, context, metric):
    renamed = events({}, {"patient_id": None}).withColumnRenamed("patient_id", "member")
    profile = dataclasses.replace(MEDICAL, entity="member", required=("member",),
                                  duplicate_key=("member", "service_date"))
    found = completeness.completeness(context(renamed, profile))
    assert metric(found, "required_fields", "member_null_percentage").value == 50.0
