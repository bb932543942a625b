"""Registered queries with SQL, on the given tables."""

import pytest
from compare import check, duck

from seatwise.llm import oracle, queries

FOLDER = "/root/testdata/sf0.01"
ORACLE = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert check(queries.queries()[name](spark, FOLDER), duck(FOLDER), ORACLE[name]) > 0
