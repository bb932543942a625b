"""The report kept up to date from day to day, without reading the license table.

Kept are the licenses held per user, type, product and status (``held_counts``) and the
report itself. A day's changes are signed counts of the same form: new licenses, and
expired ones as minus one of their old row and plus one of their new row. A user who is
counted in a group or no longer counted can only be one of those with changes, so the
report moves by the difference of what these users counted for before and after.

As after any run, no ACTIVE license is past its date: expire what is due first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.operators.matching import having_match

HELD = ("userid", "license_type", "product_name", "status")
GROUP = ("report", "license_type", "product_name", "license_status")


def held_counts(licenses: DataFrame) -> DataFrame:
    """Licenses per user, type, product and status."""
    return licenses.groupBy(*HELD).agg(F.count(F.lit(1)).alias("licenses"))


def _signed(rows: DataFrame, sign: int, status: Column | None = None) -> DataFrame:
    status = F.col("status") if status is None else status
    return rows.select("userid", "license_type", "product_name", status.alias("status"),
                       F.lit(sign).cast("long").alias("licenses"))


def day_changes(new_licenses: DataFrame, expired: DataFrame) -> DataFrame:
    """Signed counts of a day: ``expired`` has the old rows of the licenses that expire."""
    parts = (_signed(new_licenses, 1), _signed(expired, -1),
             _signed(expired, 1, F.lit("EXPIRED")))
    return _summed(reduce(DataFrame.unionByName, parts))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*HELD).agg(F.sum("licenses").alias("licenses")).filter("licenses <> 0")


def merged(counts: DataFrame) -> DataFrame:
    """One row per group out of counts and signed changes kept beside each other."""
    return _summed(counts.select(*HELD, "licenses"))


def advance_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """The held counts after the changes. Groups that no license is left in go."""
    return merged(counts.select(*HELD, "licenses").unionByName(changes.select(*HELD, "licenses")))


def _levels(counts: DataFrame) -> DataFrame:
    """Counts per user and report group: five for an ACTIVE row, two for another."""
    none, active = F.lit(None).cast("string"), F.col("status") == "ACTIVE"
    kind, product = F.col("license_type"), F.col("product_name")

    def group(report: str, *values: Column) -> Column:
        return F.struct(F.lit(report).alias(GROUP[0]), *(
            v.alias(n) for v, n in zip(values, GROUP[1:], strict=True)))

    shown = F.when(active, "Active").otherwise(F.col("status"))
    always = [group("all_status", none, none, F.col("status")),
              group("all_type_status", kind, none, shown)]
    scoped = [group("active_type", kind, none, none), group("active_total", none, none, none),
              group("active_type_product", kind, product, none)]
    groups = F.when(active, F.array(*always, *scoped)).otherwise(F.array(*always))
    # Merged per user and group inside each task first, like the other counts.
    return counts.select("userid", "licenses", F.explode(groups).alias("g")).groupBy(
        "userid", *(F.col(f"g.{n}").alias(n) for n in GROUP)).agg(
        F.sum("licenses").alias("licenses"))


def report_of(counts: DataFrame) -> DataFrame:
    """``full_report`` from held counts, without its total of an empty table."""
    return _levels(counts).groupBy(*GROUP).agg(
        F.count("userid").alias("unique_users"), F.sum("licenses").alias("total_licenses"))


def advance_report(report: DataFrame, counts: DataFrame, changes: DataFrame) -> DataFrame:
    """The report after the changes; ``counts`` are the held counts before them.

    Reads the counts of changed users only; a layout by user lets that skip the others.
    """
    before = having_match(counts, changes, ["userid"])
    after = advance_counts(before, changes)
    parts = [
        report.select(*GROUP, "unique_users", "total_licenses"),
        report_of(after).select(*GROUP, "unique_users", "total_licenses"),
        report_of(before).select(*GROUP, (-F.col("unique_users")).alias("unique_users"),
                                 (-F.col("total_licenses")).alias("total_licenses")),
    ]
    summed = reduce(DataFrame.unionByName, parts).groupBy(*GROUP).agg(
        F.sum("unique_users").alias("unique_users"), F.sum("total_licenses").alias("total_licenses"))
    return summed.filter((F.col("total_licenses") != 0) | (F.col("report") == "active_total"))
