"""Every registered query against its SQL twin."""

import os

import pytest
from harness import compare, connect

import __spark_entry__ as entry_point

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert not set(ORACLES) - set(QUERIES)
