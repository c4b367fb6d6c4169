"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert compare(got, duck.execute(ORACLES[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_gives_five_regions(spark):
    assert entry.entry(spark).count() == 5
