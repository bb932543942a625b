"""Deciding license requests and issuing the licenses they ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, Moment, day, moment
from seatwise.functions.licenses import is_active, is_issuable, issued_id, term_days
from seatwise.operators.key_filter import KeyFilter, Store, cannot_occur, key_filter, may_occur
from seatwise.operators.matching import having_match, lacking_match, mark_match

REQUEST_COLUMNS = ["id", "userid", "license_type", "product_name", "requested_at"]
SEAT = ["userid", "license_type", "product_name"]

APPROVED = "APPROVED"
UNKNOWN_USER = "REJECTED_UNKNOWN_USER"
DUPLICATE = "REJECTED_DUPLICATE"
QUARANTINED = "QUARANTINED"


def pending_requests(requests: DataFrame) -> DataFrame:
    """Requests waiting for a decision; the status is compared case-sensitively."""
    return requests.filter(F.col("request_status") == "PENDING").select(*REQUEST_COLUMNS)


def known_users(users: DataFrame) -> DataFrame:
    return users.select("userid")


def active_seats(licenses: DataFrame, as_of: Day = None) -> DataFrame:
    """User, type and product of each license active now, one row per license."""
    return licenses.filter(is_active(as_of)).select(*SEAT)


def valid_requests(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Pending requests of known users."""
    return having_match(pending_requests(requests), users, ["userid"], unique=True)


def approved_requests(
    requests: DataFrame, users: DataFrame, licenses: DataFrame, as_of: Day = None
) -> DataFrame:
    """Valid requests whose user does not hold that seat yet.

    A NULL type or product matches no seat. Two requests for one seat in the same
    batch are both approved.
    """
    return lacking_match(valid_requests(requests, users), active_seats(licenses, as_of), SEAT)


def decide(
    requests: DataFrame, users: DataFrame, licenses: DataFrame, as_of: Day = None
) -> DataFrame:
    """Every pending request, all its columns, plus ``decision``.

    One pass replaces the chain of joins that keeps, then drops, then subtracts:
    the two look-ups become flags and the decision is an expression over them. User
    ids are taken as unique, being the user table's primary key.
    """
    pending = requests.filter(F.col("request_status") == "PENDING")
    flagged = mark_match(pending, users, ["userid"], "_known", unique=True)
    flagged = mark_match(flagged, active_seats(licenses, as_of), SEAT, "_held")
    decision = (
        F.when(~F.col("_known"), UNKNOWN_USER)
        .when(F.col("_held"), DUPLICATE)
        .otherwise(APPROVED)
    )
    return flagged.select(*requests.columns, decision.alias("decision"))


def request_filters(
    users: DataFrame, licenses: DataFrame, store: Store, as_of: Day = None
) -> tuple[KeyFilter | None, KeyFilter | None]:
    """Filters for the known users and for the seats held, for the functions below.

    Worth their two passes over the small sides where most pending requests name unknown
    users or free seats; None for a side too large for one.
    """
    return (
        key_filter(users, ["userid"], store, "user_filter"),
        key_filter(active_seats(licenses, as_of), SEAT, store, "seat_filter"),
    )


def valid_requests_filtered(
    requests: DataFrame, users: DataFrame, known: KeyFilter | None
) -> DataFrame:
    """``valid_requests``; requests of users that cannot occur are not shuffled."""
    return valid_requests(may_occur(requests, known), users)


def decide_filtered(
    requests: DataFrame, users: DataFrame, licenses: DataFrame,
    known: KeyFilter | None, held: KeyFilter | None, as_of: Day = None,
) -> DataFrame:
    """``decide`` with filters from ``request_filters``: the same rows.

    A request of a user that cannot occur is settled without a shuffle, one for a seat
    that cannot be held with the user's look-up alone. The three parts each read the
    pending requests, which costs scans and saves shuffles.
    """
    pending = requests.filter(F.col("request_status") == "PENDING")
    strangers = cannot_occur(pending, known).select(
        *requests.columns, F.lit(UNKNOWN_USER).alias("decision"))
    # The seat is tested first, so that both tests are on rows straight from the files.
    free = may_occur(cannot_occur(pending, held), known)
    flagged = mark_match(free, users, ["userid"], "_known", unique=True)
    free = flagged.select(
        *requests.columns,
        F.when(F.col("_known"), APPROVED).otherwise(UNKNOWN_USER).alias("decision"))
    rest = may_occur(may_occur(pending, held), known)
    return strangers.unionByName(free).unionByName(decide(rest, users, licenses, as_of))


def rejected_requests(
    requests: DataFrame, users: DataFrame, licenses: DataFrame, as_of: Day = None
) -> DataFrame:
    """Pending requests that were not approved."""
    decisions = decide(requests, users, licenses, as_of)
    return decisions.filter(F.col("decision") != APPROVED).select(*REQUEST_COLUMNS)


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("requests"))


def quarantined(decisions: DataFrame) -> DataFrame:
    """Approved requests that cannot become a license row: no type or no product."""
    return decisions.filter((F.col("decision") == APPROVED) & ~is_issuable())


def hold_quarantined(decisions: DataFrame) -> DataFrame:
    """The decisions with those of ``quarantined`` marked as such."""
    held = (F.col("decision") == APPROVED) & ~is_issuable()
    return decisions.withColumn(
        "decision", F.when(held, QUARANTINED).otherwise(F.col("decision")))


def new_licenses(
    approved: DataFrame, as_of: Day = None, now: Moment = None, random_ids: bool = False
) -> DataFrame:
    """One ACTIVE license per approved request, running from ``as_of`` for its term.

    Ids derive from the request's id and time and from ``as_of``, so a repeated run or a
    retried task issues the same license again, and a request opened again on another
    day gets a new one. ``random_ids`` draws fresh UUIDs.
    """
    license_id = F.uuid() if random_ids else issued_id(day(as_of))
    return approved.select(
        license_id.alias("license_id"),
        "userid",
        "license_type",
        day(as_of).alias("start_date"),
        F.date_add(day(as_of), term_days()).alias("expiry_date"),
        "product_name",
        F.lit("ACTIVE").alias("status"),
        moment(now).alias("created_at"),
    )


def add_licenses(licenses: DataFrame, issued: DataFrame) -> DataFrame:
    """The license table with the issued rows appended; no shuffle."""
    if "updated_at" not in issued.columns:
        issued = issued.withColumn("updated_at", F.col("created_at"))
    return licenses.unionByName(issued.select(*licenses.columns))


def not_issued_for_pending(licenses: DataFrame, requests: DataFrame) -> DataFrame:
    """Licenses except those an interrupted run issued for requests still pending.

    Such a license starts on that run's day, which its id contains, and its request was
    never processed; a request that was opened again was. A run stamps its licenses and
    its requests with one time, so a time that some request carries is that of a run that
    came to its end and decided all that waited. Licenses of such runs are set aside first:
    what a waiting request is compared with are the days of unfinished runs for its seat,
    and of licenses from elsewhere, not all days on which the seat was ever issued.
    """
    waiting = requests.filter(
        (F.col("request_status") == "PENDING") & F.col("processed_at").isNull())
    stamp = F.col("processed_at").cast(licenses.schema["created_at"].dataType)
    finished = requests.select(stamp.alias("created_at")).filter(F.col("created_at").isNotNull())
    starts = lacking_match(licenses, finished, ["created_at"]).select(*SEAT, "start_date").distinct()
    own = waiting.join(starts, SEAT).select(issued_id(F.col("start_date")).alias("license_id"))
    return lacking_match(licenses, own, ["license_id"])


def require_new_ids(licenses: DataFrame, issued: DataFrame) -> None:
    """Raise if an id that is to be issued is in the license table already."""
    taken = having_match(issued.select("license_id"), licenses, ["license_id"], unique=True).first()
    if taken is not None:
        raise ValueError(f"license id {taken['license_id']} is issued already")


def apply_decisions(
    requests: DataFrame, decisions: DataFrame, now: Moment = None, complete: bool = False
) -> DataFrame:
    """The request table after the run: as many rows as before.

    ``decisions`` comes from ``decide`` on this same table and already carries each
    decided row in full. QUARANTINED rows stay PENDING and unstamped, and so do pending
    rows that ``decisions`` lacks; ``complete`` says that there are none of those, which
    saves the look-up.
    """
    waiting = F.col("request_status").eqNullSafe("PENDING")
    untouched = requests.filter(~waiting)
    if not complete:
        untouched = untouched.unionByName(
            lacking_match(requests.filter(waiting), decisions, ["id"], unique=True))
    held = F.col("decision") == QUARANTINED
    outcome = (
        F.when(held, F.col("request_status"))
        .when(F.col("decision") == APPROVED, "APPROVED").otherwise("REJECTED")
    )
    decided = (
        decisions.withColumn("request_status", outcome)
        .withColumn("processed_at", F.when(held, F.col("processed_at")).otherwise(moment(now)))
        .select(*requests.columns)
    )
    return untouched.unionByName(decided)
