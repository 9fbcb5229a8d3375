"""Every query against its DuckDB twin, on the smallest data."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import check_oracle
import claim_views as cv

DATA = "/root/testdata/sf0.001"
SLOW = {"month_backfill", "run_suite", "combine_results", "result_append", "latest_run_view"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_every_query_has_a_twin():
    """But those of the text subpackage, some of which train models; its own tests cover them."""
    text = set(entry._text_queries())
    assert set(entry.queries()) - text == set(entry.oracle_sql()) - text
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query(spark, name):
    assert check_oracle.compare(spark, DATA, name).startswith("ok")


@pytest.mark.parametrize("name", sorted(SLOW))
def test_whole_run(spark, name):
    assert check_oracle.compare(spark, DATA, name).startswith("ok")


def test_entry(spark):
    frame = entry.entry(spark)
    rows = frame.collect()
    assert {r.check_category for r in rows} == {
        "completeness", "consistency", "uniqueness", "distribution", "temporal", "validity",
        "volume"}
    assert {r.status for r in rows} <= {"PASS", "FAIL", "WARN", "INFO"}


def test_runs_of_many_passes_join_the_events_once(spark):
    ctx = cv.context(spark, DATA)
    kept = cv.kept(ctx)
    plan = kept.events_table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert kept.events_table.dtypes == ctx.events_table.dtypes
    assert kept.events_table.exceptAll(ctx.events_table).isEmpty()
    assert kept.events_table.count() == ctx.events_table.count()
