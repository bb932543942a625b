"""Running the jobs against two databases: one with requests, one with licenses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, Moment, moment, pinned
from seatwise.operators.requests import (
    APPROVED,
    decision_counts,
    not_issued_for_pending,
    require_new_ids,
)
from seatwise.plans.jobs import Store, expire_and_refresh, license_report, process_requests
from seatwise.session import table_store, temporary_store
from seatwise.sinks import jdbc as sink
from seatwise.sources import jdbc as source
from seatwise.sources.jdbc import Database, Split
from seatwise.sources.tables import Tables, preflight

ISSUED_COLUMNS = (
    "license_id", "userid", "license_type", "start_date", "expiry_date",
    "product_name", "status", "created_at",
)


@dataclass(frozen=True)
class Place:
    """A table in a database: where to read it, how to change it."""

    database: Database
    table: str
    connect: Callable
    split: Split | None = None
    one_task: bool = False

    @property
    def staging(self) -> str:
        return f"{self.table}_staged"

    def read(self, spark: SparkSession) -> DataFrame:
        return source.read_table(spark, self.database, self.table, self.split, self.one_task)

    def change(self, rows: DataFrame, statement: str) -> int:
        sink.stage(rows, self.database, self.staging)
        return sink.apply_statements(self.connect, [statement])[0]


@dataclass(frozen=True)
class Places:
    users: Place
    licenses: Place
    requests: Place

    def read(self, spark: SparkSession) -> Tables:
        return Tables(
            users=self.users.read(spark),
            licenses=self.licenses.read(spark),
            requests=self.requests.read(spark),
        )


def request_job(
    spark: SparkSession, places: Places, as_of: Day = None, now: Moment = None,
    keep: Store | None = None,
) -> dict[str, int]:
    """Decide, issue, then update the request rows, all from one stored decision.

    The two databases commit separately. If the job dies between them, the next run
    leaves licenses issued for still pending requests out of account, so it decides
    as before, issues nothing twice and updates the request rows. An id that a license
    of another request has stops the job before it changes anything.

    ``keep`` is handed the number of requests by decision and the ACTIVE licenses per
    type after the job, as ``decision_counts`` and ``distribution``.
    """
    as_of, now = pinned(spark, as_of, now)
    with temporary_store(spark) as store:
        tables = places.read(spark)
        earlier = not_issued_for_pending(tables.licenses, tables.requests)
        run = process_requests(replace(tables, licenses=earlier), as_of, now, store)
        issued = store(run.new_licenses, "issued")
        require_new_ids(earlier, issued)
        if keep is not None:
            keep(decision_counts(run.decisions), "decision_counts")
            keep(run.distribution(), "distribution")
        changes = store(
            run.decisions.select(
                "id",
                F.when(F.col("decision") == APPROVED, "APPROVED").otherwise("REJECTED")
                .alias("request_status"),
                moment(now).alias("processed_at"),
            ),
            "request_changes",
        )
        inserted = places.licenses.change(
            issued,
            sink.insert_statement(
                places.licenses.table, places.licenses.staging, ISSUED_COLUMNS, "license_id"
            ),
        )
        updated = places.requests.change(
            changes,
            sink.update_statement(
                places.requests.table, places.requests.staging,
                ("request_status", "processed_at"), "id",
                only_where="t.request_status = 'PENDING'",
            ),
        )
        return {"licenses_issued": inserted, "requests_updated": updated}


def expiry_job(
    spark: SparkSession, places: Places, as_of: Day = None, now: Moment = None
) -> dict[str, int]:
    """Expire due licenses, then correct the flags."""
    as_of, now = pinned(spark, as_of, now)
    with temporary_store(spark) as store:
        tables = places.read(spark)
        run = expire_and_refresh(tables.users, tables.licenses, as_of, now)
        due = store(run.license_changes, "license_changes")
        flags = store(
            run.flag_changes.select(
                "userid",
                F.col("should_be_active").alias("islicenseactive"),
                moment(now).alias("updated_at"),
            ),
            "flag_changes",
        )
        expired = places.licenses.change(
            due,
            sink.update_statement(
                places.licenses.table, places.licenses.staging, ("status", "updated_at"),
                "license_id", key_type="uuid", only_where="t.status = 'ACTIVE'",
            ),
        )
        updated = places.users.change(
            flags,
            sink.update_statement(
                places.users.table, places.users.staging,
                ("islicenseactive", "updated_at"), "userid",
            ),
        )
        return {"licenses_expired": expired, "users_updated": updated}


def run_database_pipeline(
    spark: SparkSession, places: Places, as_of: Day = None, now: Moment = None,
    include_expired: bool = False, brief: bool = False,
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Probe databases and tables, run both jobs, and report on the licenses they leave.

    The licenses are copied to files once and all counts are taken from the copy. The
    results are those of ``run_pipeline`` over files: the report (with ``brief`` only
    the counts by type and the totals), the distribution after the request job, and
    the number of requests by decision.
    """
    for database in {place.database.url: place.database for place in (
        places.users, places.licenses, places.requests
    )}.values():
        source.is_reachable(spark, database)
    preflight(places.read(spark))
    as_of, now = pinned(spark, as_of, now)
    # The results stay, being what is returned; the copy of the licenses goes.
    lasting, results = table_store(spark), {}

    def keep(rows: DataFrame, name: str) -> DataFrame:
        results[name] = lasting(rows, name)
        return results[name]

    affected = {
        **request_job(spark, places, as_of, now, keep),
        **expiry_job(spark, places, as_of, now),
    }
    with temporary_store(spark) as store:
        licenses = store(places.licenses.read(spark), "licenses")
        report = license_report(
            licenses, as_of, include_expired, detailed=not brief, store=lasting)
    return affected, report | results
