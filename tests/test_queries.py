from __future__ import annotations

import pytest

from tests.compare import database, same
from tests.conftest import DATA
from textmill.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return database(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    same(QUERIES[name](spark, DATA), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_have_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    row = e.entry(spark).first()
    assert row["processed"] == row["removed_duplicates"] + row["kept"] + row["removed_deleted"] + row["removed_nsfw"] + row["removed_spam"] + row["removed_low_quality"]
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["clean_text_reddit", "quality_reason", "token_windows", "stratified_split"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
