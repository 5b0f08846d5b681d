"""Every registered query against its SQL on the smallest tables, and the contract of the entry module."""

import pytest

import __spark_entry__ as contract
from verification.compare import compare, database

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
CORPUS = {*contract.CORPUS_QUERIES}


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


def test_every_query_has_sql():
    """Those of the corpus operators, which may be left out, are listed in their own tests."""
    assert set(QUERIES) - CORPUS == set(ORACLE) - CORPUS


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["GIA", "rsq", "mape", "rmse"] and df.count() == 7


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], SMALL) == ""
