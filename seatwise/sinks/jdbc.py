"""Database writes: executors fill a staging table, then one set-based statement
per target applies it.

A retried task can write its staging rows twice, so every statement gives the same
result with repeated staging rows, and running it again changes nothing more.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from seatwise.sources.jdbc import Database

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def append_table(rows: DataFrame, database: Database, table: str, connections: int = 32) -> None:
    """Append from the executors over at most ``connections`` connections."""
    _write(rows, database, table, connections, "append")


def stage(rows: DataFrame, database: Database, table: str, connections: int = 32) -> None:
    """Fill a staging table anew. ``rows`` should be a written table: limiting the
    connections also limits the tasks that compute it."""
    _write(rows, database, table, connections, "overwrite")


def _write(rows: DataFrame, database: Database, table: str, connections: int, mode: str) -> None:
    options = {
        **database.options(),
        "dbtable": table,
        "numPartitions": str(connections),
        "truncate": "true",
    }
    rows.write.format("jdbc").options(**options).mode(mode).save()


def _names(*names: str) -> None:
    for name in names:
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain SQL name: {name!r}")


def insert_statement(
    target: str, staging: str, columns: Sequence[str], key: str, key_type: str = "uuid"
) -> str:
    """Insert staged rows, ignoring keys the target already holds."""
    _names(target, staging, key, key_type, *columns)
    values = ", ".join(f"CAST({c} AS {key_type})" if c == key else c for c in columns)
    return (
        f"INSERT INTO {target} ({', '.join(columns)}) "
        f"SELECT DISTINCT {values} FROM {staging} ON CONFLICT ({key}) DO NOTHING"
    )


def update_statement(
    target: str,
    staging: str,
    columns: Sequence[str],
    key: str,
    key_type: str | None = None,
    only_where: str = "",
) -> str:
    """Copy ``columns`` of staged rows to the target rows with the same key.

    ``only_where`` is a further condition on the target, named ``t``.
    """
    _names(target, staging, key, *columns, *([key_type] if key_type else []))
    assignments = ", ".join(f"{c} = s.{c}" for c in columns)
    staged_key = f"CAST(s.{key} AS {key_type})" if key_type else f"s.{key}"
    condition = f" AND {only_where}" if only_where else ""
    return (
        f"UPDATE {target} AS t SET {assignments} "
        f"FROM (SELECT DISTINCT {key}, {', '.join(columns)} FROM {staging}) AS s "
        f"WHERE t.{key} = {staged_key}{condition}"
    )


def apply_statements(connect: Callable, statements: Sequence[str]) -> list[int]:
    """Run the statements in one transaction; the affected rows of each.

    ``connect`` opens a Python DB-API connection. Only statements pass through the
    driver, never rows. Any error rolls everything back and is raised.
    """
    connection = connect()
    try:
        cursor = connection.cursor()
        affected = []
        for statement in statements:
            cursor.execute(statement)
            affected.append(cursor.rowcount)
        connection.commit()
        return affected
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
