"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload import load_all

from .oracle import DATA, compare, database

FOLDER = f"{DATA}/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(load_all()))
def test_equals_oracle(spark, db, name):
    assert compare(spark, db, name, FOLDER) is None


def test_every_query_has_an_oracle():
    assert set(load_all()) <= set(entry.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", [
    "b06_order_status", "b12_unit_costs", "b16_invoice_base", "b21_portfolio", "j13_partial_match",
    "j14_interval_lookup", "j16_date_spine", "b24_rate_calendar", "i03_upsert"])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = load_all()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
