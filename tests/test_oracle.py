"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

from checks.compare import difference, duckdb_tables
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return duckdb_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, db, name):
    assert difference(spark, db, SF_DIR, name) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 387
