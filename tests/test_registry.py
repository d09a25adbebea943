"""Every named query against its check SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from quireworks.registry import CHECKS, QUERIES
from tools.check import connect, difference


@pytest.fixture(scope="module")
def duck(small):
    return connect(Path(small))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, small, duck, name):
    got = QUERIES[name](spark, small).toPandas()
    assert difference(got, duck.sql(CHECKS[name]).df()) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_no_cross_join_in_any_plan(spark, small):
    batch = [n for n in QUERIES if not n.startswith("ingest_") and "file" not in n]
    for name in sorted(set(batch) - {"decoded_pages", "directory_ingest", "title_ledger_ingest"}):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
