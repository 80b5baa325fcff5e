"""Every query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = difference(entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name], duck)
    assert found is None, found


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 30 * 24
