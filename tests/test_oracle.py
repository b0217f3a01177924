"""The correctness gate in miniature: every registered query against its DuckDB
oracle on the smallest scale factor (the driver runs the same at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare, duck
from tessera.plans import catalog

SF = "/root/testdata/sf0.001"
catalog.load_all()
QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert res["ok"], res


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    from tessera.plans.catalog import ROWS_ONLY
    assert rows_only <= set(ROWS_ONLY), rows_only - set(ROWS_ONLY)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "hist_runs" in df.columns
