"""Every query against its SQL counterpart in another engine."""

import os

import pytest

import __spark_entry__ as contract
from compare import differences, oracle_connection
from mercata.plans import catalog, oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_same_keys():
    assert set(catalog.QUERIES) == set(oracle.build())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    assert differences(df, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
