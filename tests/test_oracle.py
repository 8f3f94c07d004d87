"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
from pointset.plans import catalog
from tools.check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""
    spark.catalog.clearCache()


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r.n for r in rows) == 500
