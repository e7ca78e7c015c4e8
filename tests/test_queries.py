"""Every checked query against DuckDB on the same tables, all rows, exactly."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests import oracle
from tickloom.plans.queries import ORACLES as SQL
from tickloom.plans.queries import QUERIES as RUNS


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(RUNS) == set(SQL)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query(spark, con, sf_dir, name):
    _, fault = oracle.compare(spark, con, RUNS[name], SQL[name], sf_dir)
    assert not fault


def test_contract_has_them_all():
    assert set(RUNS) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
