"""Known keys kept from run to run, so that only arriving rows are checked for uniqueness.

The keys of a table are kept by a hash of the key, in as many folders as there are parts, one
set of files per batch. An arriving batch is compared with itself and with the parts it falls
into; a batch that is found unique is then taken in. The table itself is never grouped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.operators.matching import having_match
from seatwise.operators.quality import repeated_keys
from seatwise.sinks.laid_out import PART, hash_part

PARTS = 64


class KeyTable:
    """The keys of one table under ``folder``. A NULL key is no key and never repeats."""

    def __init__(self, spark: SparkSession, folder: str, key: str, parts: int = PARTS):
        self.spark, self.folder, self.key, self.parts = spark, folder.rstrip("/"), key, parts

    def _by_part(self, rows: DataFrame) -> DataFrame:
        keys = rows.filter(F.col(self.key).isNotNull()).select(self.key)
        return keys.withColumn(PART, hash_part(F.col(self.key), self.parts))

    def start(self, rows: DataFrame) -> None:
        """Take the keys of a table that holds each once; the one pass over it."""
        self._by_part(rows).limit(0).drop(PART).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/schema")
        self._write(rows, "first")

    def _write(self, rows: DataFrame, batch: str) -> None:
        (self._by_part(rows).distinct().repartitionByRange(PART, self.key).sortWithinPartitions(self.key)
         .write.mode("overwrite").partitionBy(PART).parquet(f"{self.folder}/keys/batch={batch}"))

    def known(self) -> DataFrame:
        """All keys, with their batch and part, on which filters choose folders."""
        schema = self.spark.read.parquet(f"{self.folder}/schema").schema
        return self.spark.read.schema(schema.add("batch", "string").add(PART, "string")).parquet(
            f"{self.folder}/keys")

    def repeated(self, arriving: DataFrame, batch: str | None = None) -> DataFrame:
        """Keys of the arriving rows that occur twice among them or are known already.

        ``batch`` names a batch that may have been taken in before; its keys do not count.
        """
        keys = self._by_part(arriving)
        touched = [r[PART] for r in keys.select(PART).distinct().collect()]
        known = self.known().filter(F.col(PART).isin(touched))
        if batch is not None:
            known = known.filter(F.col("batch") != batch)
        taken = having_match(keys.select(self.key), known, [self.key])
        twice = repeated_keys(keys, self.key).select(self.key)
        return taken.unionByName(twice).distinct()

    def take(self, arriving: DataFrame, batch: str | None = None) -> str:
        """Check a batch and take its keys in; raises if one repeats. Returns its name.

        A batch of a given name can be taken again after an interruption.
        """
        batch = batch or uuid.uuid4().hex
        found = self.repeated(arriving, batch).first()
        if found is not None:
            raise ValueError(f"{self.key} {found[0]} occurs more than once")
        self._write(arriving, batch)
        return batch
