"""Every registered query against its checking SQL on the smallest tables, and the shape of plans."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as register
from metaloom.operators import registry
from metaloom.plans.fixtures import fixture
from metaloom.plans.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(register.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF) == ""


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(register.oracle_sql()) <= set(register.queries())


def test_entry(spark):
    rows = register.entry(spark)
    assert rows.columns == ["host", "n_pages", "n_links"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_joins(spark, name):
    if name.startswith(("crawl", "catalog_walk", "redirect", "quad_union_diff", "quad_tangled_diff")):
        pytest.skip("runs level by level; its joins are equi-joins on checkpointed rows")
    plan = register.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_on_the_registry_runs_below_everything(spark):
    plan = registry.todo(fixture(spark, SF, "registry"))._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan.split("Join")[-1]


def test_scans_read_only_what_they_need(spark):
    plan = register.queries()["failure_summary"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
