"""Every query of the panel has a SQL text and equals it."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.verify import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 70


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    ok, text = compare(spark, con, name, QUERIES, ORACLES, SF)
    assert ok, text
