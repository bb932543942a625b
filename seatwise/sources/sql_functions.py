"""The operators as SQL functions over the registered views.

After ``register`` of the tables and ``register_functions``, SQL text can call

    license_term('Type 2')                         days that a new license runs
    license_is_active(status, expiry_date, day)    as in the reports
    licenses_due(day), active_seats(day)           table functions, like the operators
    license_counts(day), user_flag_drift(day), approved_license_requests(day)

Spark expands them into the query, so filters on them reach the scans.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from seatwise.schemas import OTHER_TERM_DAYS, TERM_DAYS

_ACTIVE = "status = 'ACTIVE' AND expiry_date >= day"
_SEAT = ("license_type", "product_name")


def _types(spark: SparkSession, view: str, *columns: str) -> str:
    """The columns with the types that they have in a view."""
    found = dict(spark.table(view).dtypes)
    return ", ".join(f"{c} {found[c]}" for c in columns)


def register_functions(spark: SparkSession) -> None:
    """Create the functions for this session; needs the views users, licenses and requests."""
    terms = " ".join(f"WHEN '{name}' THEN {days}" for name, days in TERM_DAYS.items())
    seat = _types(spark, "licenses", "userid", *_SEAT)
    functions = {
        "license_term(kind STRING) RETURNS INT":
            f"CASE kind {terms} ELSE {OTHER_TERM_DAYS} END",
        "license_is_active(status STRING, expiry_date DATE, day DATE) RETURNS BOOLEAN": _ACTIVE,
        f"licenses_due(day DATE) RETURNS TABLE ({_types(spark, 'licenses', 'license_id')})":
            "SELECT license_id FROM licenses WHERE status = 'ACTIVE' AND expiry_date < day",
        f"active_seats(day DATE) RETURNS TABLE ({seat})":
            f"SELECT userid, license_type, product_name FROM licenses WHERE {_ACTIVE}",
        "license_counts(day DATE) RETURNS TABLE "
        "(license_type STRING, unique_users BIGINT, total_licenses BIGINT)":
            # Per user first, so that a hot user sends one row per task.
            "SELECT license_type, count(userid), sum(copies) FROM (SELECT userid, license_type, "
            f"count(*) AS copies FROM licenses WHERE {_ACTIVE} GROUP BY userid, license_type) "
            "GROUP BY license_type",
        f"user_flag_drift(day DATE) RETURNS TABLE ({_types(spark, 'users', 'userid')}, "
        "should_be_active BOOLEAN)":
            "SELECT u.userid, h.userid IS NOT NULL FROM users u LEFT JOIN (SELECT DISTINCT userid "
            f"FROM licenses WHERE {_ACTIVE}) h ON u.userid = h.userid "
            "WHERE u.islicenseactive <> (h.userid IS NOT NULL)",
        "approved_license_requests(day DATE) RETURNS TABLE "
        f"({_types(spark, 'requests', 'id', 'userid', *_SEAT, 'requested_at')})":
            "SELECT r.id, r.userid, r.license_type, r.product_name, r.requested_at FROM requests r "
            "LEFT SEMI JOIN users u ON r.userid = u.userid LEFT ANTI JOIN (SELECT DISTINCT userid, "
            "license_type, product_name, xxhash64(userid, license_type, product_name) AS digest "
            f"FROM licenses WHERE {_ACTIVE}) s ON r.userid = s.userid "
            "AND r.license_type = s.license_type AND r.product_name = s.product_name "
            "AND xxhash64(r.userid, r.license_type, r.product_name) = s.digest "
            "WHERE r.request_status = 'PENDING'",
    }
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
