"""Parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seatwise.sources.tables import Tables


def write_table(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``; a failed job leaves no success marker there."""
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_tables(tables: Tables, folder: str) -> None:
    for name, rows in tables.items():
        write_table(rows, f"{folder.rstrip('/')}/{name}")
