"""Every registered query against its checking SQL, on the smallest test tables."""

import pytest

import __spark_entry__ as spark_entry
from suite.catalog import CHECKS, QUERIES
from suite.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "SupplierKey" and len(df.columns) == 25
    assert spark_entry.queries().keys() >= QUERIES.keys()
    assert spark_entry.oracle_sql().keys() <= spark_entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in CHECKS:
        assert compare(df, con, CHECKS[name]) is None
    else:
        assert df.count() >= 0
