"""Reading tables over JDBC, in parallel where a split column is given."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Connection settings, passed to every read and write."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    fetchsize: int = 10_000
    batchsize: int = 10_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetchsize),
            "batchsize": str(self.batchsize),
            "preferTimestampNTZ": "true",
            **self.extra,
        }


@dataclass(frozen=True)
class Split:
    """Read a table as ``parts`` ranges of a numeric, date or timestamp column.

    The bounds only set the stride: rows outside them, and rows where the column is
    NULL, are still read.
    """

    column: str
    lower: str | int
    upper: str | int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def read_table(
    spark: SparkSession, database: Database, table: str, split: Split | None = None,
    one_task: bool = False,
) -> DataFrame:
    """A whole table; Spark sends the filters and columns a query uses to the database.

    Without a ``split`` one task reads all of it, which the caller must ask for.
    """
    if split is None and not one_task:
        raise ValueError(f"{table}: give a split, or one_task for a small table")
    options = {**database.options(), **(split.options() if split else {}), "dbtable": table}
    return spark.read.format("jdbc").options(**options).load()


def read_query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**database.options(), query=query).load()


def is_reachable(spark: SparkSession, database: Database) -> bool:
    """Run a one-row query; raises with the driver's message if that fails."""
    return read_query(spark, database, "SELECT 1 AS probe").count() == 1
