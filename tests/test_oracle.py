"""Every registered query against its independent SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
import trip_queries.oracle
import trip_queries.registry
from tests.oracle_check import same, tables

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no data in {SF_DIR}")


@pytest.fixture(scope="module")
def duck():
    return tables(SF_DIR)


def test_each_query_has_sql():
    own = set(trip_queries.registry.REGISTRY)
    assert own == set(trip_queries.oracle.ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(trip_queries.oracle.ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert same(result, duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
