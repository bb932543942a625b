"""Tables kept in parts, of which a change set rewrites only those that it touches.

A table is a folder of Parquet files partitioned by ``_part``, an expression over columns
that no change alters, so a changed row stays in its part. Licenses are laid out by month
of expiry and sorted by status inside it: a day's expiries lie in one or two months, and
the row-group statistics of older months show that none of their rows is ACTIVE. Requests
are laid out by ranges of the id, where the pending ones are the latest; users by hash.

A change is staged beside the tables first. ``commit`` marks the staged parts as whole and
then puts them in place (``partitionOverwriteMode=dynamic``); ``recover`` puts them in place
again after a run that ended half way, and drops what was staged but not marked.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, day
from seatwise.functions.licenses import is_due
from seatwise.operators.matching import lacking_match
from seatwise.session import file_system
from seatwise.sources.tables import Tables

PART = "_part"
_PENDING, _READY, _SCHEMA = ".pending", "_READY", ".schema"


def month_part(date: Column) -> Column:
    return F.coalesce(F.concat(F.lit("m"), F.date_format(date, "yyyy-MM")), F.lit("m"))


def range_part(number: Column, width: int) -> Column:
    return F.coalesce(
        F.concat(F.lit("r"), F.lpad(F.floor(number / width).cast("string"), 12, "0")), F.lit("r"))


def hash_part(key: Column, parts: int) -> Column:
    return F.concat(F.lit("h"), F.lpad(F.pmod(F.xxhash64(key), F.lit(parts)).cast("string"), 6, "0"))


@dataclass(frozen=True)
class Layout:
    """Key of a table, the part of a row, the columns the part depends on, and the order inside."""

    key: str
    part: Callable[[], Column]
    by: tuple[str, ...]
    sort: tuple[str, ...]


REQUESTS_PER_PART = 1_000_000
USER_PARTS = 64

LAYOUTS = {
    "users": Layout("userid", lambda: hash_part(F.col("userid"), USER_PARTS), ("userid",),
                    ("userid",)),
    "licenses": Layout("license_id", lambda: month_part(F.col("expiry_date")), ("expiry_date",),
                       ("status", "expiry_date")),
    "requests": Layout("id", lambda: range_part(F.col("id"), REQUESTS_PER_PART), ("id",), ("id",)),
}


@dataclass(frozen=True)
class Staged:
    """What a change set touches: parts, of how many, and rows changed and added."""

    parts: int
    of: int
    changed: int
    added: int


class LaidOut:
    """The tables under one folder."""

    def __init__(self, spark: SparkSession, folder: str, layouts: dict[str, Layout] | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.layouts = layouts or LAYOUTS

    def create(self, name: str, rows: DataFrame) -> None:
        layout = self.layouts[name]
        # A table without rows has no file that tells its columns.
        rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{_SCHEMA}/{name}")
        self._write(rows.withColumn(PART, layout.part()), f"{self.folder}/{name}", layout)

    def create_all(self, tables: Tables) -> None:
        for name, rows in tables.items():
            self.create(name, rows)

    def parts(self, name: str) -> DataFrame:
        """The table with its ``_part``, on which filters choose folders."""
        schema = self.spark.read.parquet(f"{self.folder}/{_SCHEMA}/{name}").schema
        return self.spark.read.schema(schema.add(PART, "string")).parquet(f"{self.folder}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.parts(name).drop(PART)

    def tables(self) -> Tables:
        return Tables(**{name: self.read(name) for name in ("users", "licenses", "requests")})

    def due(self, as_of: Day = None) -> DataFrame:
        """The licenses to expire, whole rows; months after ``as_of`` are not read."""
        past = F.col(PART) <= month_part(day(as_of))
        return self.parts("licenses").filter(past & is_due(as_of)).drop(PART)

    def unexpired(self, as_of: Day = None) -> DataFrame:
        """Licenses that end on ``as_of`` or later, from the months that can have some."""
        running = (F.col(PART) >= month_part(day(as_of))) & (F.col("expiry_date") >= day(as_of))
        return self.parts("licenses").filter(running).drop(PART)

    def stage(self, name: str, changes: DataFrame | None = None,
              inserts: DataFrame | None = None) -> Staged:
        """Write the touched parts anew, beside the table.

        ``changes`` has the key, the columns of the layout, unchanged, and the new values of
        any others, a key at most once. ``inserts`` has whole rows; one whose key its part
        holds already is left out, so a repeated run adds nothing twice.
        """
        layout, table = self.layouts[name], self.parts(name)
        frames = [f.withColumn(PART, layout.part()) for f in (changes, inserts) if f is not None]
        # One row per part of the table at most.
        touched = [r[PART] for r in reduce(
            DataFrame.union, [f.select(PART) for f in frames]).distinct().collect()]
        total = table.select(PART).distinct().count()
        if not touched:
            return Staged(0, total, 0, 0)
        columns = table.columns
        kept = table.filter(F.col(PART).isin(touched)).withColumns(
            {"_changed": F.lit(False), "_added": F.lit(False)})
        if changes is not None:
            fixed = (layout.key, *layout.by)
            new = [c for c in changes.columns if c not in fixed]
            marked = changes.select(layout.key, F.lit(True).alias("_found"), *(
                F.col(c).alias(f"_new_{c}") for c in new))
            found = F.coalesce("_found", F.lit(False))
            kept = kept.join(marked, layout.key, "left").select(*(
                F.when(found, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in new else c
                for c in columns), found.alias("_changed"), "_added")
        if inserts is not None:
            added = frames[-1].select(*columns).withColumns(
                {"_changed": F.lit(False), "_added": F.lit(True)})
            kept = kept.unionByName(lacking_match(
                added, table.filter(F.col(PART).isin(touched)), [layout.key], unique=True))
        seen = Observation()
        self._write(kept, f"{self.folder}/{_PENDING}/{name}", layout, lambda rows: rows.observe(
            seen, F.count_if("_changed").alias("changed"), F.count_if("_added").alias("added"),
        ).select(*columns))
        return Staged(len(touched), total, seen.get["changed"], seen.get["added"])

    def commit(self) -> None:
        """Put all staged parts in place."""
        files, pending = file_system(self.spark, f"{self.folder}/{_PENDING}")
        if not files.exists(pending):
            return
        ready = f"{self.folder}/{_PENDING}/{_READY}"
        _, marker = file_system(self.spark, ready)
        files.create(marker, True).close()
        for name in self.layouts:
            staged = f"{self.folder}/{_PENDING}/{name}"
            if files.exists(file_system(self.spark, staged)[1]):
                (self.spark.read.parquet(staged).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy(PART)
                 .parquet(f"{self.folder}/{name}"))
        files.delete(pending, True)

    def recover(self) -> bool:
        """Finish a commit that was interrupted, or drop what was staged without one."""
        files, pending = file_system(self.spark, f"{self.folder}/{_PENDING}")
        whole = files.exists(file_system(self.spark, f"{self.folder}/{_PENDING}/{_READY}")[1])
        if whole:
            self.commit()
        elif files.exists(pending):
            files.delete(pending, True)
        return whole

    def _write(self, rows: DataFrame, path: str, layout: Layout,
               last: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        # By ranges, so that a large part is several files and a small one is whole. What is
        # counted is counted behind the shuffle (``last``): its sampling reads rows as well.
        order = (PART, *layout.sort)
        dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        last(dealt).write.mode("overwrite").partitionBy(PART).parquet(path)
