"""How often the claim views join the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import claim_views as cv

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("previous", [cv.PREVIOUS, None])
@pytest.mark.parametrize("profile", [cv.MEDICAL, cv.PHARMACY])
def test_a_month_context_has_the_events_of_its_months(spark, profile, previous):
    whole = cv.context(spark, DATA, profile, scope="month", previous=previous)
    month = cv.month_context(spark, DATA, profile, previous=previous)
    for mine in (month, cv.kept(month)):
        a, b = whole.compared(), mine.compared()
        assert a.count() > 0
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_the_orders_of_a_month_are_sent_to_the_line_items(spark):
    """Their own size decides, not that of all orders."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    size = os.path.getsize(f"{DATA}/orders.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size // 3))
    try:
        whole = cv.context(spark, DATA, scope="month").events()
        assert "SortMergeJoin" in plan_of(whole)
        assert "SortMergeJoin" not in plan_of(cv.month_context(spark, DATA).events())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["run_suite", "suite_first_month", "custom_checks", "combine_results"])
def test_a_run_joins_its_events_once(spark, name):
    assert "l_orderkey" not in plan_of(entry.queries()[name](spark, DATA))


def test_a_run_made_twice_joins_its_events_once(spark, monkeypatch):
    made, run = [], entry.suite.run_suite
    monkeypatch.setattr(entry.suite, "run_suite", lambda contexts, *rest, **more: (
        made.extend(contexts), run(contexts, *rest, **more))[1])
    entry.queries()["rerun_counts_once"](spark, DATA)
    assert len(made) == 4
    assert not any("l_orderkey" in plan_of(ctx.events_table) for ctx in made)
    assert made[:2] == made[2:]
