"""Every registered query against its SQL, on the generated tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tests.conftest import SF_DIR

SQL = contract.core_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.core_queries()))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, contract.core_queries()[name], SQL[name]) is None


def test_every_query_has_sql():
    assert set(SQL) == set(contract.core_queries())


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns[-2:] == ["reason", "reason_detail"]
    assert found.count() == 6
