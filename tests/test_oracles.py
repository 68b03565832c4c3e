"""Every registered query returns the rows of its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from compare import SMALL, connect, differences

from trailperks.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, connection, name):
    assert name in ORACLES, f"{name} has no SQL counterpart"
    assert differences(spark, name, QUERIES[name], ORACLES[name], SMALL, connection) == []


def test_contract_holds_them_all():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).first()["nb_salaries"] == 150


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(QUERIES)
