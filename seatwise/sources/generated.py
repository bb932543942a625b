"""Synthetic tables, drawn per row from a seed so that every run gives the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.clock import day, moment
from seatwise.functions.licenses import license_id_for
from seatwise.functions.picks import choice, digest, number
from seatwise.schemas import LICENSE_TYPES
from seatwise.sources.tables import Tables

# The products and statuses that generated licenses carry.
PRODUCTS = ("Math101", "SciMaster", "CodeCamp")
STATUSES = ("ACTIVE", "EXPIRED")

FIRST_NAMES = ("Ada", "Bela", "Chidi", "Dora", "Emil", "Fatima", "Goran", "Hana", "Ivo", "Jun")
LAST_NAMES = ("Abara", "Berg", "Castro", "Dahl", "Endo", "Fischer", "Gupta", "Haddad", "Ito", "Jung")


def user_ids(spark: SparkSession, count: int, parts: int | None = None) -> DataFrame:
    """Ids 1 to ``count``, made by the executors."""
    return spark.range(1, count + 1, numPartitions=parts).select(F.col("id").alias("user_no"))


def generate_users(ids: DataFrame, as_of: dt.date, seed: int = 0) -> DataFrame:
    """One user per ``user_no``: a name, a unique email, a last login earlier in the
    year of ``as_of``, and a random flag."""
    year_start = dt.date(as_of.year, 1, 1)
    seconds = max((as_of - year_start).days, 1) * 86_400
    drawn = ids.select("user_no", digest(seed, "user", F.col("user_no")).alias("_d"))
    first, last = choice(F.col("_d"), 0, FIRST_NAMES), choice(F.col("_d"), 1, LAST_NAMES)
    login = moment(f"{year_start} 00:00:00") + F.make_dt_interval(
        secs=number(F.col("_d"), 2, seconds)
    )
    return drawn.select(
        F.col("user_no").cast("string").alias("userid"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(
            F.lower(first), F.lit("."), F.lower(last), F.lit("."),
            F.col("user_no").cast("string"), F.lit("@example.org"),
        ).alias("email"),
        login.alias("lastlogin"),
        (number(F.col("_d"), 3, 2) == 1).alias("islicenseactive"),
        moment(f"{as_of} 00:00:00").alias("created_at"),
        moment(f"{as_of} 00:00:00").alias("updated_at"),
    )


def generate_licenses(ids: DataFrame, as_of: dt.date, seed: int = 0) -> DataFrame:
    """One license per user: started within the past year, expiring within the next,
    with a random type, product and status."""
    drawn = ids.select(
        "user_no",
        digest(seed, "license", F.col("user_no")).alias("_d"),
        digest(seed, "dates", F.col("user_no")).alias("_t"),
    )
    return drawn.select(
        license_id_for(F.concat(F.lit(f"{seed}:"), F.col("user_no").cast("string")))
        .alias("license_id"),
        F.col("user_no").cast("string").alias("userid"),
        choice(F.col("_d"), 0, LICENSE_TYPES).alias("license_type"),
        F.date_sub(day(as_of), number(F.col("_t"), 0, 366).cast("int")).alias("start_date"),
        F.date_add(day(as_of), number(F.col("_t"), 1, 365).cast("int") + 1).alias("expiry_date"),
        choice(F.col("_d"), 1, PRODUCTS).alias("product_name"),
        choice(F.col("_d"), 2, STATUSES).alias("status"),
        moment(f"{as_of} 00:00:00").alias("created_at"),
        moment(f"{as_of} 00:00:00").alias("updated_at"),
    )


def generate_requests(ids: DataFrame, as_of: dt.date, seed: int = 0) -> DataFrame:
    """One pending request per user for a random type and product."""
    drawn = ids.select("user_no", digest(seed, "request", F.col("user_no")).alias("_d"))
    return drawn.select(
        F.col("user_no").alias("id"),
        F.col("user_no").cast("string").alias("userid"),
        F.lit("PENDING").alias("request_status"),
        choice(F.col("_d"), 0, LICENSE_TYPES).alias("license_type"),
        choice(F.col("_d"), 1, PRODUCTS).alias("product_name"),
        moment(f"{as_of} 00:00:00").alias("requested_at"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
    )


def generate_tables(ids: DataFrame, as_of: dt.date, seed: int = 0) -> Tables:
    return Tables(
        users=generate_users(ids, as_of, seed),
        licenses=generate_licenses(ids, as_of, seed),
        requests=generate_requests(ids, as_of, seed),
    )
