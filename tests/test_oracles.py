"""Every registered query of the core against its DuckDB oracle on the smallest driver tables,
plus the driver's smoke entry point."""

import os

import pytest

import __spark_entry__ as E
from contrail.plans import catalog
from oracle_compare import compare, duck

SF = os.environ.get("CONTRAIL_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_core_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["status"] == "ok", r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "reliability_rank" in df.columns
