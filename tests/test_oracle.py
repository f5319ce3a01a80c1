"""Every query against its SQL, exactly, on the smallest supplied tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from shelfmark.checks.oracle import ORACLE
from shelfmark.checks.queries import QUERIES
from tests.comparing import differences, duckdb_over


@pytest.fixture(scope="module")
def con():
    from tests.conftest import SF_DIR

    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, key):
    df = driver.queries()[key](spark, sf_dir)
    assert differences(df, con, driver.oracle_sql()[key]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert slow not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
