"""Registered queries of this subpackage against their SQL."""

import pytest

from rowguard.llm.queries import QUERIES, SQL
from tests.oracle_check import same, tables


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert same(QUERIES[name](spark, sf_dir), tables(sf_dir), SQL[name]) == []
