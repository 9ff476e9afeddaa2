"""Every query of the library's own operators against its SQL twin in DuckDB."""

import os

import oracle
import pytest

import __spark_entry__ as entry
from queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert name in entry.oracle_sql()
    assert oracle.compare(df, con, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["id", "timepoint"]
