"""Distinct-user and license counts. Every count is exact.

Rows are first merged per user and report key, then counted per report key. Repeats
merge inside each task before the shuffle, so a user who owns a third of the rows
sends one row per task and key. The user id comes first among the grouping columns:
where a task meets more keys than its memory holds, Spark sorts them, and a sort that
starts with a nearly unique column is much the faster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.functions.clock import Day
from seatwise.functions.licenses import in_scope, shown_status


def _per_user(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("userid", *by).agg(F.count(F.lit(1)).alias("_copies"))


def _unique(name: str) -> Column:
    return F.count("userid").alias(name)


def _total() -> Column:
    return F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_licenses")


def _tally(rows: DataFrame, *by: str) -> DataFrame:
    return _per_user(rows, *by).groupBy(*by).agg(_unique("unique_users"), _total()).orderBy(*by)


def counts_by_type(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    return _tally(licenses.filter(in_scope(as_of, include_expired)), "license_type")


def counts_by_type_and_product(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    return _tally(
        licenses.filter(in_scope(as_of, include_expired)), "license_type", "product_name"
    )


def counts_by_status(licenses: DataFrame) -> DataFrame:
    return _tally(licenses, "status")


def expiry_breakdown(licenses: DataFrame, as_of: Day = None) -> DataFrame:
    """Counts per type and shown status. "Expired" (past its date, not yet updated)
    and "EXPIRED" (already updated) are separate groups."""
    rows = licenses.select("userid", "license_type", shown_status(as_of).alias("license_status"))
    return _tally(rows, "license_type", "license_status")


def totals(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    """One row, also for an empty table."""
    return _per_user(licenses.filter(in_scope(as_of, include_expired))).agg(
        _unique("total_unique_users"), _total()
    )


def distribution(licenses: DataFrame) -> DataFrame:
    """Counts per type over ACTIVE rows, whatever their expiry date."""
    active = licenses.filter(F.col("status") == "ACTIVE")
    return _tally(active, "license_type").withColumnRenamed("unique_users", "user_count")


def counts_at_all_levels(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    """By type, by type and product, and overall, from one scan.

    ``level`` tells the three apart. An empty table gives the total row alone.
    """
    user, kind, product = (F.col(c) for c in ("userid", "license_type", "product_name"))
    rows = licenses.filter(in_scope(as_of, include_expired))
    level = (
        F.when(F.grouping("license_type") == 1, "total")
        .when(F.grouping("product_name") == 1, "type")
        .otherwise("type_product")
    )
    per_user = rows.groupingSets(
        [[user, kind], [user, kind, product], [user]], user, kind, product
    ).agg(level.alias("level"), F.count(F.lit(1)).alias("_copies"))
    counted = per_user.groupBy("license_type", "product_name", "level").agg(
        _unique("unique_users"), _total()
    )
    nobody = licenses.sparkSession.range(1).select(*(
        F.lit("total").alias(name) if name == "level"
        else F.lit(0 if name in ("unique_users", "total_licenses") else None)
        .cast(counted.schema[name].dataType).alias(name)
        for name in counted.columns
    ))
    return counted.unionByName(nobody).groupBy("license_type", "product_name", "level").agg(
        F.sum("unique_users").alias("unique_users"), F.sum("total_licenses").alias("total_licenses")
    )


def status_levels(licenses: DataFrame, as_of: Day = None) -> DataFrame:
    """By raw status, and by type and shown status, from one scan."""
    user, status, kind, shown = (
        F.col(c) for c in ("userid", "status", "license_type", "license_status")
    )
    rows = licenses.select(
        "userid", "status", "license_type", shown_status(as_of).alias("license_status")
    )
    level = F.when(F.grouping("status") == 0, "status").otherwise("type_status")
    per_user = rows.groupingSets(
        [[user, status], [user, kind, shown]], user, status, kind, shown
    ).agg(level.alias("level"), F.count(F.lit(1)).alias("_copies"))
    return per_user.groupBy("status", "license_type", "license_status", "level").agg(
        _unique("unique_users"), _total()
    )


def detailed_summary(licenses: DataFrame, as_of: Day = None) -> dict[str, DataFrame]:
    return {
        "active_by_type": counts_by_type(licenses, as_of),
        "by_status": counts_by_status(licenses),
        "expiry_breakdown": expiry_breakdown(licenses, as_of),
    }


def report_in_scope(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    """The part of ``full_report`` that counts rows in scope."""
    return counts_at_all_levels(licenses, as_of, include_expired).select(
        F.concat(F.lit("active_"), "level").alias("report"),
        "license_type",
        "product_name",
        F.lit(None).cast("string").alias("license_status"),
        "unique_users",
        "total_licenses",
    )


def full_report(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    """All five report tables as one, told apart by ``report``.

    Two scans instead of five: the counts in scope read only ACTIVE rows, which the
    scan can filter, and the status counts read everything.
    """
    in_scope_rows = report_in_scope(licenses, as_of, include_expired)
    by_status = status_levels(licenses, as_of).select(
        F.concat(F.lit("all_"), "level").alias("report"),
        "license_type",
        F.lit(None).cast("string").alias("product_name"),
        F.coalesce("status", "license_status").alias("license_status"),
        "unique_users",
        "total_licenses",
    )
    return in_scope_rows.unionByName(by_status)


def split_report(report: DataFrame, brief: bool = False) -> dict[str, DataFrame]:
    """The single report tables out of a stored ``full_report``, sorted."""

    def part(name: str, *by: str) -> DataFrame:
        rows = report.filter(F.col("report") == name)
        return rows.select(*by, "unique_users", "total_licenses").orderBy(*by)

    total = report.filter(F.col("report") == "active_total").agg(
        F.coalesce(F.max("unique_users"), F.lit(0)).alias("total_unique_users"),
        F.coalesce(F.max("total_licenses"), F.lit(0)).alias("total_licenses"),
    )
    counts = {"by_type": part("active_type", "license_type"), "totals": total}
    if brief:
        return counts
    return counts | {
        "by_type_and_product": part("active_type_product", "license_type", "product_name"),
        "by_status": part("all_status", "license_status")
        .withColumnRenamed("license_status", "status"),
        "expiry_breakdown": part("all_type_status", "license_type", "license_status"),
    }
