"""Short forms for table rows in tests."""

import datetime as dt

from seatwise.schemas import LICENSES, REQUESTS, USERS

AS_OF = dt.date(2025, 9, 10)
NOW = dt.datetime(2025, 9, 10, 7, 0, 0)
OLD = dt.datetime(2024, 1, 1, 0, 0, 0)
BEFORE, ON, AFTER = dt.date(2025, 9, 9), AS_OF, dt.date(2025, 9, 11)


def users(spark, *rows):
    """(userid, flag) rows."""
    return spark.createDataFrame(
        [(u, f"Name {u}", f"{u}@x.org", None, flag, OLD, OLD) for u, flag in rows], USERS)


def licenses(spark, *rows):
    """(license_id, userid, type, product, status, expiry) rows."""
    return spark.createDataFrame(
        [(i, u, kind, dt.date(2020, 1, 1), expiry, product, status, OLD, OLD)
         for i, u, kind, product, status, expiry in rows], LICENSES)


def requests(spark, *rows):
    """(id, userid, status, type, product) rows."""
    return spark.createDataFrame(
        [(i, u, status, kind, product, OLD, None) for i, u, status, kind, product in rows],
        REQUESTS)


def values(rows, *columns):
    picked = rows.select(*columns) if columns else rows
    return sorted((tuple(r) for r in picked.collect()), key=repr)
