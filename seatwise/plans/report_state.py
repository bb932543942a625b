"""The state of the running report in a folder: held counts in parts by user, and the report.

Counts are laid out by a hash of the user. A day adds the signed changes of its users, in the
same parts, and a report of its own; it reads the parts of these users and no others. A day
counts once its report is whole, so a run that ends early can be repeated from the state of
the day before. ``compact`` merges the changes of all days into whole counts again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.clock import Day
from seatwise.operators import reports, running_report
from seatwise.session import file_system
from seatwise.sinks.laid_out import PART, hash_part
from seatwise.sinks.parquet import write_table

PARTS = 64


class ReportState:
    """Kept under ``folder``; one folder per day, of which the latest whole one counts."""

    def __init__(self, spark: SparkSession, folder: str, parts: int = PARTS):
        self.spark, self.folder, self.parts = spark, folder.rstrip("/"), parts

    def start(self, licenses: DataFrame, as_of: dt.date) -> None:
        """From a license table after its run: the one scan of it."""
        counts = running_report.held_counts(licenses)
        write_table(counts.limit(0).coalesce(1), f"{self.folder}/schema")
        self._write(counts, f"{self._day(as_of)}/whole")
        write_table(reports.full_report(licenses, as_of).coalesce(1), f"{self._day(as_of)}/report")

    def _day(self, as_of: Day) -> str:
        return f"{self.folder}/day={as_of}"

    def _write(self, counts: DataFrame, path: str) -> None:
        dealt = counts.withColumn(PART, hash_part(F.col("userid"), self.parts))
        (dealt.repartitionByRange(PART, "userid").write.mode("overwrite").partitionBy(PART)
         .parquet(path))

    def _read(self, path: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.folder}/schema").schema
        return self.spark.read.schema(schema.add(PART, "string")).parquet(path)

    def _days_with(self, table: str) -> list[str]:
        files, root = file_system(self.spark, self.folder)
        found = [s.getPath() for s in files.listStatus(root)] if files.exists(root) else []
        return sorted(p.getName().removeprefix("day=") for p in found if files.exists(
            file_system(self.spark, f"{p.toString()}/{table}/_SUCCESS")[1]))

    def days(self) -> list[str]:
        """Days with a whole report, in order."""
        return self._days_with("report")

    def report(self, as_of: Day = None) -> DataFrame:
        day = str(as_of or self.days()[-1])
        return self.spark.read.parquet(f"{self._day(day)}/report")

    def counts(self) -> DataFrame:
        """Held counts: the latest whole ones, and the signed changes of the days after."""
        whole = self._days_with("whole")[-1]
        counts = self._read(f"{self._day(whole)}/whole")
        for day in self.days():
            if day > whole:
                counts = counts.unionByName(self._read(f"{self._day(day)}/changes"))
        return counts

    def advance(self, new_licenses: DataFrame, expired: DataFrame, as_of: dt.date) -> DataFrame:
        """Take in a day's new licenses and the old rows of its expired ones; the report.

        A day taken in already is not taken in again.
        """
        days = self.days()
        if str(as_of) in days:
            return self.report(as_of)
        if str(as_of) < days[-1]:
            raise ValueError(f"the state is of {days[-1]}, after {as_of}")
        day = self._day(as_of)
        self._write(running_report.day_changes(new_licenses, expired), f"{day}/changes")
        changes = self._read(f"{day}/changes")
        # One value per part at most; it prunes the folders of users without changes.
        touched = [r[PART] for r in changes.select(PART).distinct().collect()]
        held = running_report.merged(self.counts().filter(F.col(PART).isin(touched)))
        write_table(running_report.advance_report(self.report(), held, changes).coalesce(1),
                    f"{day}/report")
        return self.report(as_of)

    def compact(self) -> None:
        """Whole counts of the latest day; then the days before it are dropped."""
        *earlier, last = self.days()
        if not earlier:
            return
        self._write(running_report.merged(self.counts()), f"{self._day(last)}/whole")
        for day in earlier:
            files, place = file_system(self.spark, self._day(day))
            files.delete(place, True)
