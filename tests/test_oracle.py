"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from check import compare, duck
from oreflow.registry import all_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, rows = compare(spark, con, QUERIES[name], SF_DIR)
    assert verdict in ("same", "rows-only"), verdict
    assert rows > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
