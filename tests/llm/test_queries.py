"""The registered queries on the smallest tables, against SQL where there is some."""

import pytest

import __spark_entry__ as entry
from tidemark.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert compare(got, connect(SF_DIR).execute(ORACLES[name]).to_arrow_table()) is None


def test_all_operators_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
