"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from compare import differences, duck
from corpusloom.plans import queries as registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, connection, name):
    # A few selections of pending work are empty on 200 documents.
    assert differences(spark, connection, FOLDER, name, may_be_empty=True) == []


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(registered.queries()) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
