"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as contract
import harness
from routeline.plans.catalog import QUERIES

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return harness.connect(ROOT)


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert "trip_id" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = contract.queries()[name](spark, ROOT)
    assert harness.difference(df, con, contract.oracle_sql()[name]) is None
