"""Every registered query against its SQL, on the given tables."""

import pytest
from compare import check, duck

import __spark_entry__ as registry

QUERIES = registry.library_queries()
ORACLE = registry.library_sql()
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    found = check(QUERIES[name](spark, FOLDER), connection, ORACLE[name])
    assert found > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert registry.entry(spark).count() == 3
