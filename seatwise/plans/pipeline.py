"""Running the pipeline over Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, Moment, pinned
from seatwise.operators import expiry, reports, requests
from seatwise.plans.jobs import plan_pipeline
from seatwise.plans.validation import require_unique_keys
from seatwise.sinks.whole import Output, whole_output
from seatwise.sources.tables import Tables, preflight, read_parquet


def run_pipeline(
    spark: SparkSession,
    tables: Tables,
    out: str,
    as_of: Day = None,
    now: Moment = None,
    snapshots: bool = True,
    check_keys: bool = True,
    by_status: bool = False,
    include_expired: bool = False,
    brief: bool = False,
    roots: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Run all jobs and write their results under the new folder ``out``.

    They appear there together at the end; a run that fails leaves ``out`` as it was, and
    a run into a folder with results replaces them as a whole. ``out`` must lie apart from the input: from ``roots``, or else from all files of
    the tables, which takes a listing of them.

    The decisions are written first and read back by every later step. Change sets
    (decisions, issued and expired licenses, corrected flags) are always written;
    ``snapshots`` adds the three full tables. ``check_keys`` costs one aggregation of
    the user ids and one of the pending request ids. ``by_status`` writes the license
    table in one folder per status, so that the next run, which needs ACTIVE rows for
    all but the status counts, skips the others; an empty status, which has no folder, is
    refused. With fixed ``as_of`` and ``now`` a run that was interrupted can be repeated
    with the same results. ``brief`` returns only the counts by type and the totals.
    """
    if roots is None:
        roots = [path for _, rows in tables.items() for path in rows.inputFiles()]
        roots += sorted({path.rsplit("/", 1)[0] for path in roots})
    as_of, now = pinned(spark, as_of, now)
    with whole_output(spark, out, roots) as output:
        preflight(tables)
        if check_keys:
            require_unique_keys(tables)
        if by_status and not tables.licenses.filter(F.col("status") == "").isEmpty():
            raise ValueError("an empty status cannot be kept by one folder per status")
        _write_results(
            output, tables, as_of, now, snapshots, check_keys, by_status, include_expired)
    results = reports.split_report(output.table("report"), brief)
    decided = output.table("decisions").filter(F.col("decision") != requests.QUARANTINED)
    results["distribution"] = output.table("distribution")
    results["decision_counts"] = requests.decision_counts(decided)
    results["run_counts"] = output.table("run_counts")
    return results


def _write_results(
    output: Output, tables: Tables, as_of: Day, now: Moment, snapshots: bool, check_keys: bool,
    by_status: bool, include_expired: bool,
) -> None:
    store = output.store
    run = plan_pipeline(tables, as_of, now, store)
    issued = store(run.requests_run.new_licenses, "new_licenses")
    if check_keys:
        requests.require_new_ids(tables.licenses, issued)
    store(run.requests_run.quarantined, "quarantined")
    # Counted while they are written, so neither is read again for it.
    expired, updated = Observation(), Observation()
    store(run.expiry_run.license_changes.observe(
        expired, F.count(F.lit(1)).alias("rows")), "license_changes")
    flag_changes = store(run.expiry_run.flag_changes.observe(
        updated, F.count(F.lit(1)).alias("rows")), "flag_changes")
    licenses_after = run.licenses_after
    if snapshots:
        users_after = expiry.apply_flag_changes(tables.users, flag_changes, now)
        store(users_after, "after/users")
        store(run.requests_after, "after/requests")
        licenses_after = store(
            licenses_after, "after/licenses", ["status"] if by_status else ()
        )
    store(reports.full_report(licenses_after, as_of, include_expired), "report")
    store(run.requests_run.distribution(), "distribution")
    store(output.spark.range(1).select(
        F.lit(expired.get["rows"]).cast("long").alias("licenses_expired"),
        F.lit(updated.get["rows"]).cast("long").alias("users_updated")), "run_counts")


def run_on_folder(
    spark: SparkSession, folder: str, out: str, as_of: Day = None, now: Moment = None, **options: bool
) -> dict[str, DataFrame]:
    """``run_pipeline`` with its options on Parquet tables under ``folder``."""
    return run_pipeline(
        spark, read_parquet(spark, folder), out, as_of, now, roots=[folder], **options)
