"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from checks import verify
from checks.oracle import oracle_sql
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    return verify.connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(oracle_sql()) == set(QUERIES) <= set(contract.queries())
    assert set(oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, sf_dir, name):
    same, note = verify.compare(spark, database, name, sf_dir)
    assert same, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0
