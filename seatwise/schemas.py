"""Table schemas, value domains and the license term policy."""

from __future__ import annotations

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("userid", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("lastlogin", T.TimestampNTZType()),
    T.StructField("islicenseactive", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

LICENSES = T.StructType([
    T.StructField("license_id", T.StringType(), False),
    T.StructField("userid", T.StringType(), False),
    T.StructField("license_type", T.StringType(), False),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("expiry_date", T.DateType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

REQUESTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("userid", T.StringType(), False),
    T.StructField("request_status", T.StringType(), False),
    T.StructField("license_type", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("requested_at", T.TimestampNTZType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

BY_NAME = {"users": USERS, "licenses": LICENSES, "requests": REQUESTS}
PRIMARY_KEYS = {"users": "userid", "licenses": "license_id", "requests": "id"}

# The domains and terms that stored data uses.
LICENSE_TYPES = ("Type 1", "Type 2", "Type 3")
LICENSE_STATUSES = ("ACTIVE", "EXPIRED", "SUSPENDED", "REVOKED")
REQUEST_STATUSES = ("PENDING", "APPROVED", "REJECTED", "PROCESSING", "FAILED")
TERM_DAYS = {"Type 1": 30, "Type 2": 90, "Type 3": 365}
OTHER_TERM_DAYS = 30
EMAIL_PATTERN = "(?i)^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
MAX_LENGTHS = {
    "users": {"userid": 50, "name": 255, "email": 255},
    "licenses": {"userid": 50, "license_type": 20, "product_name": 100, "status": 20},
    "requests": {"userid": 50, "request_status": 20, "license_type": 20, "product_name": 100},
}


def mismatches(found: T.StructType, wanted: T.StructType) -> list[str]:
    """What keeps ``found`` from serving as ``wanted``; extra columns are allowed."""
    present = {field.name: field.dataType for field in found}
    problems = []
    for field in wanted:
        if field.name not in present:
            problems.append(f"{field.name}: missing")
        elif present[field.name] != field.dataType:
            problems.append(
                f"{field.name}: {present[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    return problems
