"""Every registered query against its DuckDB oracle on the smallest test-data scale."""

import os

import pytest

from oracle import compare, duck

import __spark_entry__ as entry
from ecospark.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

QUERIES = {n: q for n, q in entry.queries().items() if n in catalog.QUERIES}
ORACLES = {n: s for n, s in entry.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["family", "n_otu", "n_obs", "reads"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert ok, msg
