"""Predicates and derived columns of licenses and requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, day
from seatwise.schemas import LICENSE_TYPES, OTHER_TERM_DAYS, TERM_DAYS


def is_active(as_of: Day = None, inclusive: bool = True) -> Column:
    """ACTIVE and not past its expiry date.

    The jobs count the expiry day itself (``inclusive``); the per-row flag refresh
    of the license table does not.
    """
    expiry = F.col("expiry_date")
    running = expiry >= day(as_of) if inclusive else expiry > day(as_of)
    return (F.col("status") == "ACTIVE") & running


def in_scope(as_of: Day = None, include_expired: bool = False) -> Column:
    """Rows a report counts. ``include_expired`` drops only the date test: rows
    whose status is already EXPIRED stay out either way."""
    return F.col("status") == "ACTIVE" if include_expired else is_active(as_of)


def is_due(as_of: Day = None) -> Column:
    """ACTIVE although the expiry date has passed."""
    return (F.col("status") == "ACTIVE") & (F.col("expiry_date") < day(as_of))


def shown_status(as_of: Day = None) -> Column:
    """ACTIVE rows shown as Active or Expired by date, all others by raw status."""
    return (
        F.when(is_active(as_of), "Active")
        .when(is_due(as_of), "Expired")
        .otherwise(F.col("status"))
    )


def term_days(license_type: str | Column = "license_type") -> Column:
    """Days a new license of this type runs; unknown and NULL types get the default."""
    kind = F.col(license_type) if isinstance(license_type, str) else license_type
    return F.coalesce(
        *(F.when(kind == name, F.lit(days)) for name, days in TERM_DAYS.items()),
        F.lit(OTHER_TERM_DAYS),
    )


def license_id_for(*parts: Column) -> Column:
    """A UUID-shaped id that is the same on every run and task retry.

    The parts as text, NULL as an empty one, make up the key.
    """
    key = F.concat_ws("|", *(F.coalesce(part.cast("string"), F.lit("")) for part in parts))
    digest = F.md5(key.cast("binary"))
    return F.concat_ws(
        "-", *(F.substring(digest, start, size) for start, size in
               ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    )


def issued_id(start: Column) -> Column:
    """The id of the license issued for a request at ``start``: a request that is opened
    again later gets another one."""
    asked = F.date_format("requested_at", "yyyyMMddHHmmssSSSSSS")
    return license_id_for(F.col("id"), asked, start)


def is_issuable() -> Column:
    """The license table accepts this request's type and product."""
    return F.coalesce(
        F.col("license_type").isin(*LICENSE_TYPES) & F.col("product_name").isNotNull(),
        F.lit(False),
    )
