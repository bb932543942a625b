"""Users, licenses and requests derived from a customer/orders/events star schema.

Every column is an expression over the row it comes from, so the derived tables
grow with the source tables and are computed while scanning them.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.sources.tables import Tables

AS_OF = dt.date(2001, 1, 1)
NOW = dt.datetime(2001, 1, 1, 6, 0, 0)
#: Added to a customer's number it gives that of nobody.
UNKNOWN = 1_000_000_000_000

# The source columns used here. Giving them saves the job that reads file footers.
SOURCE_COLUMNS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _holder(user: str, key: str) -> str:
    """The user of a row; that of one row in eleven is no customer."""
    return f"IF({key} % 11 = 7, {user} + {UNKNOWN}, {user}) AS userid"


def star_users(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS userid",
        "c_name AS name",
        "CASE WHEN c_custkey % 7 = 0 THEN 'bad at x' "
        "ELSE concat(replace(c_name, '#', '.'), '@X.co!!') END AS email",
        "CAST(NULL AS TIMESTAMP_NTZ) AS lastlogin",
        "CASE WHEN c_custkey % 10 <> 8 THEN c_acctbal > 5000 END AS islicenseactive",
        "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at",
    )


def star_licenses(orders: DataFrame) -> DataFrame:
    """The status is nested IFs, which a filter on it folds down to the one comparison
    that the scan can apply."""
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS license_id",
        _holder("o_custkey", "o_orderkey"),
        "CASE o_orderkey % 3 WHEN 0 THEN 'Type 1' WHEN 1 THEN 'Type 2' ELSE 'Type 3' END "
        "AS license_type",
        "CAST(o_orderdate AS DATE) AS start_date",
        "date_add(CAST(o_orderdate AS DATE), "
        "CASE o_orderkey % 3 WHEN 0 THEN 30 WHEN 1 THEN 90 ELSE 365 END) AS expiry_date",
        "o_orderpriority AS product_name",
        "IF(o_orderstatus <=> 'O', 'ACTIVE', IF(o_orderstatus <=> 'F', 'EXPIRED', "
        "IF(o_orderkey % 2 = 0, 'SUSPENDED', 'REVOKED'))) AS status",
        "o_orderdate AS created_at",
        "o_orderdate AS updated_at",
    )


def star_requests(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS id",
        _holder("user_id", "event_id"),
        "CASE event_id % 5 WHEN 3 THEN 'APPROVED' WHEN 4 THEN 'REJECTED' ELSE 'PENDING' END "
        "AS request_status",
        "CASE event_id % 4 WHEN 0 THEN 'Type 1' WHEN 1 THEN 'Type 2' WHEN 2 THEN 'Type 3' END "
        "AS license_type",
        "CASE event_type WHEN 'click' THEN '1-URGENT' WHEN 'view' THEN '2-HIGH' "
        "WHEN 'error' THEN '3-MEDIUM' WHEN 'signup' THEN '4-NOT SPECIFIED' "
        "WHEN 'purchase' THEN '5-LOW' END AS product_name",
        "ts AS requested_at",
        "CASE WHEN event_id % 5 > 2 THEN ts END AS processed_at",
    )


def raw_users(users: DataFrame) -> DataFrame:
    """Users as they might arrive: some without a name, with overlong ones, or twice."""
    once = users.selectExpr(
        "IF(userid % 29 = 3, NULL, userid) AS userid",
        "IF(userid % 31 = 4, NULL, IF(userid % 37 = 5, repeat(name, 20), name)) AS name",
        "IF(userid % 41 = 6, NULL, IF(userid % 43 = 7, repeat(email, 20), email)) AS email",
        "lastlogin", "islicenseactive", "created_at", "updated_at",
    )
    again = users.where("userid % 47 = 8").withColumn("name", F.lit("again"))
    return once.unionByName(again)


def raw_licenses(licenses: DataFrame) -> DataFrame:
    """Licenses as they might arrive: values missing, outside their domain, too long, dates
    the wrong way round, ids that occur twice."""
    number = "CAST(license_id AS BIGINT)"
    return licenses.selectExpr(
        f"IF({number} % 101 = 1, NULL, IF({number} % 103 = 2, '0', license_id)) AS license_id",
        f"IF({number} % 107 = 3, NULL, userid) AS userid",
        f"CASE WHEN {number} % 109 = 4 THEN NULL WHEN {number} % 113 = 5 THEN 'Type 9' "
        f"WHEN {number} % 127 = 6 THEN repeat(license_type, 4) ELSE license_type END AS license_type",
        f"IF({number} % 131 = 7, NULL, start_date) AS start_date",
        f"CASE WHEN {number} % 137 = 8 THEN NULL WHEN {number} % 139 = 9 THEN start_date "
        f"WHEN {number} % 149 = 10 THEN date_add(start_date, -1) ELSE expiry_date END AS expiry_date",
        f"CASE WHEN {number} % 151 = 11 THEN NULL WHEN {number} % 157 = 12 "
        "THEN repeat(product_name, 30) ELSE product_name END AS product_name",
        f"CASE WHEN {number} % 163 = 13 THEN NULL WHEN {number} % 167 = 14 THEN 'active' "
        f"WHEN {number} % 173 = 15 THEN repeat(status, 6) ELSE status END AS status",
        "created_at", "updated_at",
    )


def raw_requests(requests: DataFrame) -> DataFrame:
    """Requests as they might arrive."""
    return requests.selectExpr(
        "CASE WHEN id % 101 = 1 THEN NULL WHEN id % 103 = 2 THEN 0 ELSE id END AS id",
        "IF(id % 107 = 3, NULL, userid) AS userid",
        "CASE WHEN id % 109 = 4 THEN NULL WHEN id % 113 = 5 THEN 'pending' "
        "WHEN id % 127 = 6 THEN repeat(request_status, 5) ELSE request_status END AS request_status",
        "IF(id % 131 = 7, repeat('Type 1', 9), license_type) AS license_type",
        "IF(id % 137 = 8, repeat(product_name, 30), product_name) AS product_name",
        "requested_at", "processed_at",
    )


class StarTables:
    """The three derived tables, each set up when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def users(self) -> DataFrame:
        return star_users(read_source(self.spark, self.folder, "customer"))

    @cached_property
    def licenses(self) -> DataFrame:
        return star_licenses(read_source(self.spark, self.folder, "orders"))

    @cached_property
    def requests(self) -> DataFrame:
        return star_requests(read_source(self.spark, self.folder, "events"))

    @cached_property
    def raw(self) -> Tables:
        """The tables before any rule was enforced: all rows, some of them broken."""
        return Tables(
            raw_users(self.users), raw_licenses(self.licenses), raw_requests(self.requests))

    def items(self) -> list[tuple[str, DataFrame]]:
        return [("users", self.users), ("licenses", self.licenses), ("requests", self.requests)]
