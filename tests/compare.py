"""Running a query in Spark and its SQL in DuckDB, and comparing the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(folder):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in rows), key=repr)


def check(spark_rows, connection, sql):
    """Assert equal columns, types and rows; the number of rows."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    wanted = connection.execute(sql).fetchall()
    assert sorted(spark_rows.columns) == sorted(d[0] for d in described)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in spark_rows.schema}
    assert types == {d[0]: d[1] for d in described}
    found = rows_of(spark_rows.columns, [tuple(r) for r in spark_rows.collect()])
    expected = rows_of([d[0] for d in described], wanted)
    assert len(found) == len(expected)
    assert found == expected
    return len(found)
