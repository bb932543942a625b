"""The three jobs as lazy plans, and the three in a row.

A run sets up each of its results when first asked for.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, Moment
from seatwise.operators import expiry, reports, requests
from seatwise.sources.tables import Tables

Store = Callable[[DataFrame, str], DataFrame]


def _as_is(rows: DataFrame, name: str) -> DataFrame:
    return rows


@dataclass(frozen=True)
class RequestRun:
    """Result of the request job."""

    tables: Tables
    as_of: Day
    now: Moment
    store: Store

    @cached_property
    def _all_decisions(self) -> DataFrame:
        t = self.tables
        decided = requests.decide(t.requests, t.users, t.licenses, self.as_of)
        return self.store(requests.hold_quarantined(decided), "decisions")

    @cached_property
    def decisions(self) -> DataFrame:
        return self._all_decisions.filter(F.col("decision") != requests.QUARANTINED)

    @cached_property
    def quarantined(self) -> DataFrame:
        return self._all_decisions.filter(F.col("decision") == requests.QUARANTINED)

    @cached_property
    def new_licenses(self) -> DataFrame:
        approved = self.decisions.filter(F.col("decision") == requests.APPROVED)
        return requests.new_licenses(approved, self.as_of, self.now)

    @cached_property
    def requests_after(self) -> DataFrame:
        return requests.apply_decisions(
            self.tables.requests, self._all_decisions, self.now, complete=True
        )

    @cached_property
    def licenses_after(self) -> DataFrame:
        return requests.add_licenses(self.tables.licenses, self.new_licenses)

    def distribution(self) -> DataFrame:
        """ACTIVE licenses per type once the new ones are in."""
        return reports.distribution(self.licenses_after)


def process_requests(
    tables: Tables, as_of: Day = None, now: Moment = None, store: Store = _as_is
) -> RequestRun:
    """Decide the pending requests and issue licenses for the approved ones.

    ``store`` keeps the decisions once, so that issuing licenses cannot change what
    the status update sees. Approved requests without a usable type or product get
    no license and stay PENDING.
    """
    return RequestRun(tables, as_of, now, store)


@dataclass(frozen=True)
class ExpiryRun:
    """Result of the expiry job."""

    users: DataFrame
    licenses: DataFrame
    as_of: Day
    now: Moment

    @cached_property
    def license_changes(self) -> DataFrame:
        return expiry.expired_changes(self.licenses, self.as_of, self.now)

    @cached_property
    def flag_changes(self) -> DataFrame:
        return expiry.flag_drift(self.users, self.licenses, self.as_of)

    @cached_property
    def licenses_after(self) -> DataFrame:
        return expiry.expire_licenses(self.licenses, self.as_of, self.now)

    @cached_property
    def users_after(self) -> DataFrame:
        return expiry.refresh_flags(self.users, self.licenses, self.as_of, self.now)

    def counts(self) -> dict[str, int]:
        return {
            "licenses_expired": self.license_changes.count(),
            "users_updated": self.flag_changes.count(),
        }


def expire_and_refresh(
    users: DataFrame, licenses: DataFrame, as_of: Day = None, now: Moment = None
) -> ExpiryRun:
    """Expire due licenses and correct the flags of users they leave without one.

    The flags are read off the licenses as they came in: a license that is due is
    not active whether or not its status has been updated yet, and this way the
    filter on status and date reaches the scan.
    """
    return ExpiryRun(users, licenses, as_of, now)


def license_report(
    licenses: DataFrame, as_of: Day = None, include_expired: bool = False, detailed: bool = True,
    store: Store = _as_is,
) -> dict[str, DataFrame]:
    """Counts by type and totals; with ``detailed`` also by product and by status.

    ``store`` keeps the report once, so that its tables do not each scan the licenses.
    """
    if not detailed:
        report = store(reports.report_in_scope(licenses, as_of, include_expired), "report")
    else:
        report = store(reports.full_report(licenses, as_of, include_expired), "report")
    return reports.split_report(report, brief=not detailed)


@dataclass(frozen=True)
class PipelineRun:
    """Result of all jobs in a row."""

    requests_run: RequestRun

    @cached_property
    def expiry_run(self) -> ExpiryRun:
        first = self.requests_run
        return expire_and_refresh(
            first.tables.users, first.licenses_after, first.as_of, first.now
        )

    @property
    def users_after(self) -> DataFrame:
        return self.expiry_run.users_after

    @property
    def licenses_after(self) -> DataFrame:
        return self.expiry_run.licenses_after

    @property
    def requests_after(self) -> DataFrame:
        return self.requests_run.requests_after

    @property
    def tables(self) -> Tables:
        return Tables(self.users_after, self.licenses_after, self.requests_after)


def plan_pipeline(
    tables: Tables, as_of: Day = None, now: Moment = None, store: Store = _as_is
) -> PipelineRun:
    """Requests first, then expiry on what the first job leaves behind."""
    return PipelineRun(process_requests(tables, as_of, now, store))
