"""Every registered query agrees with its SQL on the smallest driver tables."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, con, name):
    problem = difference(spark, con, SF_DIR, name, entry.queries(), entry.oracle_sql())
    assert problem is None, problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "BASE" and not df.isEmpty()


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)
