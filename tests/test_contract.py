"""Every registered query against its SQL twin."""

import re

import pytest

import __spark_entry__ as contract
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


# The queries of the optional subpackage have tests of their own.
NAMES = [n for n in contract.queries() if n != "pipeline" and not re.match(r"op\d", n)]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    result = contract.queries()[name](spark, SF_DIR)
    if name in SQL:
        assert compare(result, connection.sql(SQL[name])) == ""
    else:
        assert result.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_names():
    assert not set(SQL) - set(contract.queries())
    assert len(NAMES) >= 70
