"""Approximate distinct users from stored sketches: on request only, never the default.

One HyperLogLog sketch per type, product, status and day of expiry makes a small table that
new days are added to and that never needs the licenses again. Sketches merge, so every level
and every ``as_of`` comes from it; totals are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.functions.clock import Day
from seatwise.functions.licenses import in_scope

#: Registers as a power of two: a relative standard error of 1.04 / sqrt(2 ** 12), 1.6%.
PRECISION = 12


def sketches(licenses: DataFrame, precision: int = PRECISION) -> DataFrame:
    """users (a sketch) and licenses (a count) per type, product, status and expiry day.

    Partly merged inside each task, so a hot user or product sends one sketch per task.
    """
    return licenses.groupBy("license_type", "product_name", "status", "expiry_date").agg(
        F.hll_sketch_agg("userid", precision).alias("users"),
        F.count(F.lit(1)).alias("licenses"))


def merge(*stored: DataFrame) -> DataFrame:
    """Sketches of several tables as one table, one row per group."""
    rows = stored[0]
    for more in stored[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("license_type", "product_name", "status", "expiry_date").agg(
        F.hll_union_agg("users").alias("users"), F.sum("licenses").alias("licenses"))


def approximate_levels(
    stored: DataFrame, as_of: Day = None, include_expired: bool = False
) -> DataFrame:
    """``counts_at_all_levels`` with estimated users; an empty table gives the total row."""
    rows = stored.filter(in_scope(as_of, include_expired))
    level = (
        F.when(F.grouping("license_type") == 1, "total")
        .when(F.grouping("product_name") == 1, "type").otherwise("type_product")
    )
    users = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0))
    found = rows.rollup("license_type", "product_name").agg(
        level.alias("level"), users.cast("long").alias("unique_users"),
        F.sum("licenses").alias("total_licenses"))
    nothing = stored.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("license_type"),
        F.lit(None).cast("string").alias("product_name"), F.lit("total").alias("level"),
        F.lit(0).cast("long").alias("unique_users"), F.lit(0).cast("long").alias("total_licenses"))
    return found.unionByName(nothing).groupBy("license_type", "product_name", "level").agg(
        F.max("unique_users").alias("unique_users"), F.max("total_licenses").alias("total_licenses"))
