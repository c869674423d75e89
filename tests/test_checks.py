"""Every check query against its SQL form, over whole tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
import checks

ROOT = "/root/testdata/sf0.001"
# Queries without a row on the smallest tables.
EMPTY = {"duplicate_definitions"}


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


def test_rows_against_an_empty_answer_are_a_difference(spark, con):
    assert differences(spark.range(5), con, "SELECT 1 AS id WHERE false") not in (None, "empty result")
    assert differences(spark.range(0), con, "SELECT 1 AS id WHERE false") == "empty result"


@pytest.mark.parametrize("name", list(checks.QUERIES))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, ROOT)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert differences(result, con, sql) == ("empty result" if name in EMPTY else None)


def test_entry(spark):
    assert entry.entry(spark).count() == 100


def test_every_sql_form_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
