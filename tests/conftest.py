"""One local session and small literal tables."""

from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

EVENTS = ("medical_event_id long, patient_id long, kh_refresh_date date, service_date date, "
          "service_to_date date, procedure_code string, procedure_code_type string, "
          "billing_npi string, rendering_npi string, referring_npi string, units double, "
          "unit_type string, ndc11 string, cohort_id string, mx_cohort string, kh_plan_id int")
NAMES = [part.split()[0] for part in EVENTS.split(", ")]


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
               .config("spark.sql.maxMetadataStringLength", "2000")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> date:
    return date.fromisoformat(text)


@pytest.fixture(scope="session")
def events(spark):
    """Make an event table from partial rows."""
    base = dict.fromkeys(NAMES) | {
        "medical_event_id": 1, "patient_id": 1, "kh_refresh_date": day("2024-03-05"),
        "service_date": day("2024-03-01"), "service_to_date": day("2024-03-02")}

    def make(*rows: dict):
        return spark.createDataFrame([tuple((base | r)[n] for n in NAMES) for r in rows], EVENTS)
    return make


@pytest.fixture(scope="session")
def context(spark):
    """A context for March 2024 over literal tables."""
    from refreshguard import MEDICAL, Context
    empty = {
        "demo": "patient_id long, kh_refresh_date date, patient_gender string, patient_yob int",
        "enroll": "patient_id long, kh_refresh_date date, start_date date, end_date date",
        "geo": "patient_id long, kh_refresh_date date, valid_from_date date, valid_to_date date, "
               "patient_state string",
        "mortality": "patient_id long, kh_refresh_date date, patient_death_date date",
        "providers": "npi string, kh_refresh_date date"}

    def make(table, profile=MEDICAL, dimensions=None, **changes):
        given = dimensions or {}
        frames = {name: spark.createDataFrame(given.get(name, []), schema)
                  for name, schema in empty.items()}
        settings = {"month": "2024-03", "previous": "2024-02", "as_of": day("2024-04-01")}
        return Context(profile=profile, events_table=table, dimensions=frames,
                       **(settings | changes))
    return make


@pytest.fixture(scope="session")
def metric():
    """The row of one metric."""
    def find(frame, check, name):
        found = [r for r in frame.collect() if r.check_name == check and r.metric_name == name]
        assert len(found) == 1, [(r.check_name, r.metric_name) for r in frame.collect()]
        return found[0]
    return find
