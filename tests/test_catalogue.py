"""Every query against its SQL counterpart, and what the catalogue promises."""

import pytest
from comparing import database, differences

import __spark_entry__ as contract
from proving import oracle, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def checking():
    return database(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)


def test_contract_offers_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees(spark, checking, name):
    assert differences(QUERIES[name](spark, FOLDER), checking, SQL[name]) == []


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0
