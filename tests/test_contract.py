"""Every registered query on the smallest test tables, against its SQL counterpart."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import TABLES, normal

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"impute_model_grid", "boosted_missing"}  # have their own tests on small frames


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in queries() if n not in SLOW])
def test_query(spark, oracle, name):
    frame = queries()[name](spark, SF_DIR)
    columns, got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in oracle_sql():
        assert got
        return
    reference = oracle.execute(oracle_sql()[name])
    want_columns, want = normal([d[0] for d in reference.description], reference.fetchall())
    assert columns == want_columns
    assert got == want


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


PLAIN = ["select_rename_filter", "cell_diff", "co_missing", "value_counts_many", "group_rank_join", "filter_counts", "validation_log"]


@pytest.mark.parametrize("name", PLAIN)
def test_plans_have_no_cartesian_products_or_python(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries()["select_rename_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(p_size,5)" in plan and "p_name" not in plan
