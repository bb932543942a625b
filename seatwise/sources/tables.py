"""The three tables as one bundle, their Parquet form, and the preflight check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from seatwise.schemas import BY_NAME, mismatches


@dataclass(frozen=True)
class Tables:
    users: DataFrame
    licenses: DataFrame
    requests: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [("users", self.users), ("licenses", self.licenses), ("requests", self.requests)]


def read_parquet(spark: SparkSession, folder: str) -> Tables:
    """``folder/{users,licenses,requests}`` read with the fixed schemas."""
    return Tables(**{
        name: spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}")
        for name, schema in BY_NAME.items()
    })


def register(spark: SparkSession, tables: Tables) -> None:
    """Make the tables available to SQL as ``users``, ``licenses`` and ``requests``."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)


def preflight(tables: Tables) -> dict[str, bool]:
    """Check schemas and read one row of each table; says which tables hold any.

    Raises if a table cannot be read or does not have the columns the jobs use.
    """
    problems = [
        f"{name}.{problem}"
        for name, rows in tables.items()
        for problem in mismatches(rows.schema, BY_NAME[name])
    ]
    if problems:
        raise ValueError("; ".join(problems))
    return {name: not rows.isEmpty() for name, rows in tables.items()}
