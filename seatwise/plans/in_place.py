"""A run over tables in parts (``sinks/laid_out.py``) that rewrites only what it changes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, Moment, moment, pinned
from seatwise.operators import expiry, requests
from seatwise.plans.jobs import process_requests
from seatwise.plans.validation import require_unique_keys
from seatwise.session import temporary_store
from seatwise.sinks.laid_out import LaidOut, Staged
from seatwise.sources.tables import Tables, preflight


@dataclass(frozen=True)
class InPlaceRun:
    """What a run changed in each table."""

    users: Staged
    licenses: Staged
    requests: Staged


def issued_rows(new_licenses: DataFrame) -> DataFrame:
    """New licenses as rows of the license table."""
    return new_licenses.withColumn("updated_at", F.col("created_at"))


def expired_rows(due: DataFrame, now: Moment) -> DataFrame:
    """Due licenses as changes: the columns that the layout needs, and the new values."""
    return due.select("license_id", "expiry_date", F.lit("EXPIRED").alias("status"),
                      moment(now).alias("updated_at"))


def decided_rows(decisions: DataFrame, now: Moment) -> DataFrame:
    """Decisions as changes to the requests; those held back change nothing."""
    outcome = F.when(F.col("decision") == requests.APPROVED, "APPROVED").otherwise("REJECTED")
    return decisions.filter(F.col("decision") != requests.QUARANTINED).select(
        "id", outcome.alias("request_status"), moment(now).alias("processed_at"))


def flag_rows(drift: DataFrame, now: Moment) -> DataFrame:
    return drift.select("userid", F.col("should_be_active").alias("islicenseactive"),
                        moment(now).alias("updated_at"))


def run_in_place(spark: SparkSession, folder: str, as_of: Day = None, now: Moment = None,
                 checks: bool = True) -> InPlaceRun:
    """Decide requests, issue and expire licenses and correct flags, in the tables themselves.

    All parts are staged before any is put in place, so a run that ends early leaves the
    tables as they were, or is finished by the next one. Licenses that ended are not read
    but for the due ones: neither decisions nor flags depend on them. ``checks`` are those of
    schemas, of unique keys and of new license ids.
    """
    kept = LaidOut(spark, folder)
    kept.recover()
    as_of, now = pinned(spark, as_of, now)
    users, asked = kept.read("users"), kept.read("requests")
    running = Tables(users, kept.unexpired(as_of), asked)
    if checks:
        preflight(running)
        require_unique_keys(running)
    with temporary_store(spark) as own:
        decided = process_requests(running, as_of, now, own)
        issued = own(issued_rows(decided.new_licenses), "new_licenses")
        if checks:
            requests.require_new_ids(kept.read("licenses"), issued)
        due = own(kept.due(as_of), "due")
        active = requests.add_licenses(running.licenses, issued)
        drift = own(expiry.flag_drift(users, active, as_of), "drift")
        result = InPlaceRun(
            kept.stage("users", flag_rows(drift, now)),
            kept.stage("licenses", expired_rows(due, now), issued),
            kept.stage("requests", decided_rows(decided.decisions, now)),
        )
    kept.commit()
    return result
