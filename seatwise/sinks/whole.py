"""Tables that appear under a folder together, or not at all."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from seatwise.session import file_system, require_apart, table_store


class Output:
    """Tables on their way to ``out``; use ``whole_output``.

    They are written to a folder beside it, ``out.unfinished``, and renamed into place
    once all are there. A reader of ``out`` sees the tables of the run before until then.
    Where a store renames by copying, the switch takes as long as the copy.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.building, self.replaced = f"{self.out}.unfinished", f"{self.out}.replaced"
        self._store = table_store(spark, self.building)
        self._schemas = {}

    def store(self, rows: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table and read it back where it is now; valid until ``publish``."""
        self._schemas[name] = rows.schema
        return self._store(rows, name, partition_by)

    def table(self, name: str) -> DataFrame:
        """A published table."""
        return self.spark.read.schema(self._schemas[name]).parquet(f"{self.out}/{name}")

    def _exists(self, path: str) -> bool:
        files, place = file_system(self.spark, path)
        return files.exists(place)

    def _move(self, source: str, target: str) -> None:
        files, place = file_system(self.spark, source)
        if not files.rename(place, file_system(self.spark, target)[1]):
            raise OSError(f"{source} could not be renamed to {target}")

    def _delete(self, path: str) -> None:
        files, place = file_system(self.spark, path)
        files.delete(place, True)

    def recover(self) -> None:
        """Undo a switch that ended half way, and drop what an earlier run left behind."""
        if self._exists(self.replaced):
            if self._exists(self.out):
                self._delete(self.replaced)
            else:
                self._move(self.replaced, self.out)
        self._delete(self.building)

    def publish(self) -> None:
        if self._exists(self.out):
            self._move(self.out, self.replaced)
        self._move(self.building, self.out)
        self._delete(self.replaced)
        for name in self._schemas:
            self.spark.catalog.refreshByPath(f"{self.out}/{name}")


@contextmanager
def whole_output(spark: SparkSession, out: str, inputs: Sequence[str]) -> Iterator[Output]:
    """An ``Output`` that is published at the end, and dropped after an error.

    ``out`` and the folders beside it that take part must lie apart from ``inputs``.
    """
    output = Output(spark, out)
    for folder in (output.out, output.building, output.replaced):
        require_apart(spark, folder, inputs)
    output.recover()
    try:
        yield output
    except BaseException:
        output._delete(output.building)
        raise
    output.publish()
