"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import check, connect

SF = os.environ.get("WAYLOOM_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert check(spark, con, SF, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns
    if name != "stream_preintegrate_t1":  # needs 200 samples at rest per vehicle
        assert not df.isEmpty()


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
