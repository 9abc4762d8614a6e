"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry_runs(spark):
    assert not entry.entry(spark).isEmpty()
