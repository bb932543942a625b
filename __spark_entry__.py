"""Registered queries and their SQL equivalents.

The users, licenses and requests tables are derived from customer, orders and
events (``seatwise.sources.star``); the SQL side derives them the same way in the
CTEs below.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seatwise.functions.clock import moment  # noqa: E402
from seatwise.functions.licenses import is_due  # noqa: E402
from seatwise.operators import expiry, quality, reports, requests, sketches, tables  # noqa: E402
from seatwise.operators.numbering import numbered  # noqa: E402
from seatwise.plans.in_place import expired_rows, run_in_place  # noqa: E402
from seatwise.plans.key_table import KeyTable  # noqa: E402
from seatwise.plans.jobs import PipelineRun, plan_pipeline, process_requests  # noqa: E402
from seatwise.plans.report_state import ReportState  # noqa: E402
from seatwise.session import shared_folder, table_store  # noqa: E402
from seatwise.sinks.laid_out import LaidOut  # noqa: E402
from seatwise.sources import generated  # noqa: E402
from seatwise.sources.sql_functions import register_functions  # noqa: E402
from seatwise.sources.tables import Tables, register  # noqa: E402
from seatwise.sources.star import AS_OF, NOW, StarTables, read_source  # noqa: E402

try:
    from seatwise.llm import oracle as llm_oracle
    from seatwise.llm import queries as llm_queries
except ModuleNotFoundError as error:
    # Deleted, or without one of its libraries; a gap inside the package is a fault.
    if (error.name or "").startswith("seatwise.") and error.name != "seatwise.llm":
        raise
    llm_oracle = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
SEED = 7


def entry(spark: SparkSession) -> DataFrame:
    """Users and licenses active now, by license type."""
    return queries()["license_counts_by_type"](spark, SMOKE_DIR)


def _decisions(t: StarTables) -> DataFrame:
    return requests.decide(t.requests, t.users, t.licenses, AS_OF)


def _filtered(t: StarTables, query: str) -> DataFrame:
    known, held = requests.request_filters(t.users, t.licenses, table_store(t.spark), AS_OF)
    if query == "valid":
        return requests.valid_requests_filtered(t.requests, t.users, known)
    return requests.decide_filtered(t.requests, t.users, t.licenses, known, held, AS_OF).select(
        *requests.REQUEST_COLUMNS, "decision")


def _approved(t: StarTables) -> DataFrame:
    return requests.approved_requests(t.requests, t.users, t.licenses, AS_OF)


def _issued(t: StarTables) -> DataFrame:
    """Rows the license table accepts; those without a type are held back."""
    return process_requests(t, AS_OF, NOW).new_licenses


def _pipeline(t: StarTables, *store: Callable) -> PipelineRun:
    return plan_pipeline(t, AS_OF, NOW, *store)


def _pipeline_report(t: StarTables) -> DataFrame:
    """The report reads the licenses twice, so the decisions are written once first."""
    after = _pipeline(t, table_store(t.spark)).licenses_after
    return reports.full_report(after, AS_OF)


def _own_folder(t: StarTables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _expired_in_place(t: StarTables) -> DataFrame:
    """A run of the day before, then one that rewrites only the parts with due licenses."""
    kept = LaidOut(t.spark, _own_folder(t, "licenses"))
    kept.create("licenses", t.licenses)
    for day in (AS_OF - dt.timedelta(days=1), AS_OF):
        kept.stage("licenses", expired_rows(kept.due(day), NOW))
        kept.commit()
    return kept.read("licenses")


def _run_in_place(name: str) -> Callable[[StarTables], DataFrame]:
    def after(t: StarTables) -> DataFrame:
        kept = LaidOut(t.spark, _own_folder(t, "tables"))
        kept.create_all(t)
        run_in_place(t.spark, kept.folder, AS_OF, NOW, checks=False)
        return kept.read(name)

    return after


def _running_report(t: StarTables) -> DataFrame:
    """The report of a month ago, moved on by what was issued and what expired since."""
    start = AS_OF - dt.timedelta(days=31)
    state = ReportState(t.spark, _own_folder(t, "report"), parts=8)
    state.start(expiry.expire_licenses(t.licenses, start, NOW), start)
    due = t.licenses.filter(is_due(AS_OF) & ~is_due(start))
    return state.advance(table_store(t.spark)(_issued(t), "issued"), due, AS_OF)


def _arriving_known(t: StarTables) -> DataFrame:
    """Users of requests who are known already or ask more than once."""
    keys = KeyTable(t.spark, _own_folder(t, "keys"), "userid", parts=8)
    keys.start(t.users)
    return keys.repeated(t.requests)


def _near_counts(t: StarTables) -> DataFrame:
    """Exact counts, and whether the estimates from stored sketches are within 6%."""
    by = ["level", "license_type", "product_name"]
    exact = reports.counts_at_all_levels(t.licenses, AS_OF)
    stored = table_store(t.spark)(sketches.sketches(t.licenses), "sketches")
    near = sketches.approximate_levels(stored, AS_OF).select(
        *(F.col(c).alias(f"_{c}") for c in by), F.col("unique_users").alias("_users"),
        F.col("total_licenses").alias("_total"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    close = F.abs(F.col("_users") - F.col("unique_users")) <= 0.06 * F.col("unique_users") + 1
    return exact.join(near, same, "left").select(
        *by, "unique_users", F.col("_total").alias("total_licenses"),
        F.coalesce(close, F.lit(False)).alias("users_near"))


def _from_sql(text: str) -> Callable[[StarTables], DataFrame]:
    def run(t: StarTables) -> DataFrame:
        register(t.spark, t)
        register_functions(t.spark)
        return t.spark.sql(text.format(day=f"DATE '{AS_OF}'"))

    return run


def _signups(t: StarTables) -> DataFrame:
    """A user row for each request, many per user, known users among them."""
    return t.requests.select(
        "id",
        "requested_at",
        "userid",
        F.concat(F.lit("Requester "), F.col("id").cast("string")).alias("name"),
        F.concat(F.lit("r"), F.col("id").cast("string"), F.lit("@example.org")).alias("email"),
        F.col("requested_at").alias("lastlogin"),
        F.lit(False).alias("islicenseactive"),
        moment(NOW).alias("created_at"),
        moment(NOW).alias("updated_at"),
    )


def _bad_standing(t: StarTables) -> DataFrame:
    """Users holding a revoked license."""
    return t.licenses.filter(F.col("status") == "REVOKED").select("userid")


def _renames(t: StarTables) -> DataFrame:
    """Users whose flag is off get a new id, the negative of the old one minus one."""
    off = t.users.filter(~F.col("islicenseactive")).select("userid")
    return off.withColumn("new_userid", -F.col("userid") - 1)


def _rule_counts(t: Tables, pick: Callable[[str], list[quality.Rule]], *names: str) -> DataFrame:
    parts = [
        quality.rule_counts(rows, pick(name), name)
        for name, rows in t.items() if name in names and pick(name)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _domain(column: str, values: tuple[str, ...]) -> Callable[[str], list[quality.Rule]]:
    return lambda table: [quality.domain_rule(column, values)]


def _key_counts(t: Tables) -> DataFrame:
    return (
        quality.key_counts(t.users, "userid", "users")
        .unionByName(quality.key_counts(t.licenses, "license_id", "licenses"))
        .unionByName(quality.key_counts(t.requests, "id", "requests"))
    )


def _bare_requests(t: StarTables) -> DataFrame:
    """Requests as they arrive: no status yet on new ones, some without a time."""
    waiting = F.col("request_status") == "PENDING"
    return t.requests.select(
        "id",
        F.col("userid").cast("string").alias("userid"),
        F.when(~waiting, F.col("request_status")).alias("request_status"),
        "license_type",
        "product_name",
        F.when(~waiting, F.col("requested_at")).alias("requested_at"),
    )


def _bare_licenses(t: StarTables) -> DataFrame:
    """Licenses as they arrive: no ids, stamps or status."""
    return t.licenses.select(
        "userid", "license_type", "start_date", "expiry_date", "product_name")


def _reissued(t: StarTables) -> DataFrame:
    """Licenses for the approved requests, and again where those are opened a year later."""
    again = AS_OF.replace(year=AS_OF.year + 1)
    return requests.new_licenses(_approved(t), AS_OF, NOW).unionByName(
        requests.new_licenses(_approved(t), again, NOW))


def _user_numbers(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_source(spark, folder, "customer")
    return customer.select((F.col("c_custkey") + 1).alias("user_no"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = library_queries()
    return found | llm_queries.queries() if llm_queries else found


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = ("users", "licenses", "requests")

    on_tables: dict[str, Callable[[StarTables], DataFrame]] = {
        # requests
        "pending_requests": lambda t: requests.pending_requests(t.requests),
        "known_users": lambda t: requests.known_users(t.users),
        "active_licenses": lambda t: requests.active_seats(t.licenses, AS_OF),
        "valid_requests": lambda t: requests.valid_requests(t.requests, t.users),
        "approved_requests": _approved,
        "rejected_requests": lambda t: requests.rejected_requests(
            t.requests, t.users, t.licenses, AS_OF),
        "request_decisions": lambda t: _decisions(t).select(
            *requests.REQUEST_COLUMNS, "decision"),
        "request_decisions_filtered": lambda t: _filtered(t, "decisions"),
        "valid_requests_filtered": lambda t: _filtered(t, "valid"),
        "decision_counts": lambda t: requests.decision_counts(_decisions(t)),
        "quarantined_requests": lambda t: requests.quarantined(_decisions(t)).select(
            *requests.REQUEST_COLUMNS),
        "new_licenses": lambda t: requests.new_licenses(_approved(t), AS_OF, NOW),
        "issue_licenses_table": lambda t: requests.add_licenses(t.licenses, _issued(t)),
        "requests_after_decision": lambda t: requests.apply_decisions(
            t.requests, _decisions(t), NOW, complete=True),
        # expiry and flags
        "licenses_to_expire": lambda t: expiry.licenses_to_expire(t.licenses, AS_OF),
        "licenses_after_expiry": lambda t: expiry.expire_licenses(t.licenses, AS_OF, NOW),
        "license_expiry_changes": lambda t: expiry.expired_changes(t.licenses, AS_OF, NOW),
        "user_license_rows": lambda t: expiry.user_licenses(
            t.users.select("userid", "islicenseactive"),
            t.licenses.select("license_id", "userid", "license_type", "status")),
        "user_license_outer": lambda t: expiry.license_counts(t.users, t.licenses),
        "active_license_count_per_user": lambda t: expiry.active_license_counts(
            t.licenses, AS_OF),
        "user_status_drift": lambda t: expiry.flag_drift(t.users, t.licenses, AS_OF),
        "user_status_drift_null_safe": lambda t: expiry.flag_drift(
            t.users, t.licenses, AS_OF, null_safe=True),
        "user_status_drift_exclusive": lambda t: expiry.flag_drift(
            t.users, t.licenses, AS_OF, inclusive=False),
        "users_after_refresh": lambda t: expiry.refresh_flags(
            t.users, t.licenses, AS_OF, NOW),
        "user_flag_exists": lambda t: expiry.flags_from_licenses(t.users, t.licenses, AS_OF),
        "flag_refresh_for_touched_users": lambda t: expiry.refresh_touched(
            t.users, expiry.expire_licenses(t.licenses, AS_OF, NOW),
            t.licenses.filter(is_due(AS_OF)), AS_OF, NOW),
        "cascade_delete_users": lambda t: expiry.remove_users(t.users, _bad_standing(t)),
        "cascade_delete_licenses": lambda t: expiry.remove_users(t.licenses, _bad_standing(t)),
        "cascade_rekey_users": lambda t: expiry.rename_unique_users(t.users, _renames(t)),
        "cascade_rekey_licenses": lambda t: expiry.rename_users(t.licenses, _renames(t)),
        # reports
        "license_counts_by_type": lambda t: reports.counts_by_type(t.licenses, AS_OF),
        "license_counts_by_type_product": lambda t: reports.counts_by_type_and_product(
            t.licenses, AS_OF),
        "license_counts_include_expired": lambda t: reports.counts_by_type(
            t.licenses, AS_OF, include_expired=True),
        "license_counts_by_type_product_include_expired":
            lambda t: reports.counts_by_type_and_product(
                t.licenses, AS_OF, include_expired=True),
        "license_counts_by_status": lambda t: reports.counts_by_status(t.licenses),
        "license_expiry_breakdown": lambda t: reports.expiry_breakdown(t.licenses, AS_OF),
        "license_totals": lambda t: reports.totals(t.licenses, AS_OF),
        "license_totals_include_expired": lambda t: reports.totals(
            t.licenses, AS_OF, include_expired=True),
        "license_distribution": lambda t: reports.distribution(t.licenses),
        "license_counts_grouping_sets": lambda t: reports.counts_at_all_levels(
            t.licenses, AS_OF),
        "license_report": lambda t: reports.full_report(t.licenses, AS_OF),
        # table changes
        "insert_ignore_users": lambda t: tables.insert_or_ignore(
            t.users, _signups(t), "userid", ["requested_at", "id"]),
        "request_defaults": lambda t: tables.fill_defaults(_bare_requests(t), "requests", NOW),
        "user_defaults": lambda t: tables.fill_defaults(
            t.users.select("userid", "name", "email", F.when(
                F.col("islicenseactive"), True).alias("islicenseactive")), "users", NOW),
        "license_defaults": lambda t: tables.fill_defaults(_bare_licenses(t), "licenses", NOW),
        "reissued_licenses": _reissued,
        # data quality
        "dq_duplicate_keys": lambda t: _key_counts(t.raw),
        "dq_duplicate_email": lambda t: quality.repeated_keys(t.users, "email"),
        "dq_nulls": lambda t: _rule_counts(t.raw, quality.not_null_rules, *every),
        "dq_bad_email": lambda t: quality.broken_rows(
            t.users, [quality.email_rule()]).select("userid", "email", "rule"),
        "dq_bad_dates": lambda t: _rule_counts(
            t.raw, lambda _: [quality.date_rule()], "licenses"),
        "dq_bad_license_status": lambda t: _rule_counts(
            t.raw, _domain("status", quality.LICENSE_STATUSES), "licenses"),
        "dq_bad_license_type": lambda t: _rule_counts(
            t.raw, _domain("license_type", quality.LICENSE_TYPES), "licenses", "requests"),
        "dq_bad_request_status": lambda t: _rule_counts(
            t.raw, _domain("request_status", quality.REQUEST_STATUSES), "requests"),
        "dq_length": lambda t: _rule_counts(t.raw, quality.length_rules, *every),
        "dq_orphan_licenses": lambda t: quality.orphan_licenses(t.licenses, t.users).select(
            "license_id", "userid"),
        "dq_report": lambda t: _rule_counts(t.raw, quality.rules_for, *every),
        # all jobs in a row
        "pipeline_report": _pipeline_report,
        "pipeline_licenses": lambda t: _pipeline(t).licenses_after,
        "pipeline_requests": lambda t: _pipeline(t).requests_after,
        "pipeline_users": lambda t: _pipeline(t).users_after,
        # tables and reports kept from run to run
        "licenses_expired_in_place": _expired_in_place,
        "in_place_licenses": _run_in_place("licenses"),
        "in_place_requests": _run_in_place("requests"),
        "in_place_users": _run_in_place("users"),
        "running_license_report": _running_report,
        "near_license_counts": _near_counts,
        "arriving_known_users": _arriving_known,
        "license_numbers": lambda t: numbered(
            t.licenses.select("license_id", "start_date"),
            [F.col("start_date"), F.col("license_id")], table_store(t.spark), "license_no"),
        # operators called from SQL text
        "sql_licenses_due": _from_sql("SELECT * FROM licenses_due({day})"),
        "sql_active_seats": _from_sql("SELECT * FROM active_seats({day})"),
        "sql_license_counts": _from_sql("SELECT * FROM license_counts({day})"),
        "sql_flag_drift": _from_sql("SELECT * FROM user_flag_drift({day})"),
        "sql_approved_requests": _from_sql("SELECT * FROM approved_license_requests({day})"),
    }

    on_ids: dict[str, Callable[[DataFrame], DataFrame]] = {
        "gen_users": lambda ids: generated.generate_users(ids, AS_OF, SEED),
        "gen_licenses": lambda ids: generated.generate_licenses(ids, AS_OF, SEED),
        "gen_requests": lambda ids: generated.generate_requests(ids, AS_OF, SEED),
    }

    result: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name, build in on_tables.items():
        result[name] = lambda spark, folder, b=build: b(StarTables(spark, folder))
    for name, build in on_ids.items():
        result[name] = lambda spark, folder, b=build: b(_user_numbers(spark, folder))
    return result


# --------------------------------------------------------------------------- SQL

_DAY = f"DATE '{AS_OF}'"
_NOW = f"TIMESTAMP '{NOW}'"

_BASE = {
    "users": """
        SELECT c_custkey AS userid, c_name AS name,
               CASE WHEN c_custkey % 7 = 0 THEN 'bad at x'
                    ELSE replace(c_name, '#', '.') || '@X.co!!' END AS email,
               CAST(NULL AS TIMESTAMP) AS lastlogin,
               CASE WHEN c_custkey % 10 <> 8 THEN c_acctbal > 5000 END AS islicenseactive,
               CAST(NULL AS TIMESTAMP) AS created_at,
               CAST(NULL AS TIMESTAMP) AS updated_at
        FROM customer""",
    "licenses": """
        SELECT CAST(o_orderkey AS VARCHAR) AS license_id,
               CASE WHEN o_orderkey % 11 = 7 THEN o_custkey + 1000000000000 ELSE o_custkey END
                   AS userid,
               'Type ' || CAST(o_orderkey % 3 + 1 AS VARCHAR) AS license_type,
               CAST(o_orderdate AS DATE) AS start_date,
               CAST(CAST(o_orderdate AS DATE) + CASE o_orderkey % 3
                    WHEN 0 THEN 30 WHEN 1 THEN 90 ELSE 365 END AS DATE) AS expiry_date,
               o_orderpriority AS product_name,
               CASE WHEN o_orderstatus = 'O' THEN 'ACTIVE'
                    WHEN o_orderstatus = 'F' THEN 'EXPIRED'
                    WHEN o_orderkey % 2 = 0 THEN 'SUSPENDED' ELSE 'REVOKED' END AS status,
               o_orderdate AS created_at, o_orderdate AS updated_at
        FROM orders""",
    "requests": """
        SELECT event_id AS id,
               CASE WHEN event_id % 11 = 7 THEN user_id + 1000000000000 ELSE user_id END
                   AS userid,
               CASE WHEN event_id % 5 <= 2 THEN 'PENDING'
                    WHEN event_id % 5 = 3 THEN 'APPROVED' ELSE 'REJECTED' END AS request_status,
               CASE WHEN event_id % 4 < 3
                    THEN 'Type ' || CAST(event_id % 4 + 1 AS VARCHAR) END AS license_type,
               CASE event_type WHEN 'click' THEN '1-URGENT' WHEN 'view' THEN '2-HIGH'
                    WHEN 'error' THEN '3-MEDIUM' WHEN 'signup' THEN '4-NOT SPECIFIED'
                    WHEN 'purchase' THEN '5-LOW' END AS product_name,
               ts AS requested_at,
               CASE WHEN event_id % 5 > 2 THEN ts END AS processed_at
        FROM events""",
}

def _license_id(request: str, asked: str, start: str) -> str:
    key = (f"md5(CAST({request} AS VARCHAR) || '|' || "
           f"coalesce(strftime({asked}, '%Y%m%d%H%M%S%f'), '') || '|' || CAST({start} AS VARCHAR))")
    return _uuid(key)


def _uuid(digest: str) -> str:
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {start}, {size})" for start, size in parts)


_LATER = f"DATE '{AS_OF.replace(year=AS_OF.year + 1)}'"
_BARE_KEY = ("md5(concat_ws('|', CAST(userid AS VARCHAR), license_type, CAST(start_date AS VARCHAR), "
             "CAST(expiry_date AS VARCHAR), product_name))")


# Rows of the base tables, some broken, for the quality rules.
_NUMBER = "CAST(license_id AS BIGINT)"
_RAW = {
    "raw_users": """
        SELECT CASE WHEN userid % 29 <> 3 THEN userid END AS userid,
               CASE WHEN userid % 31 = 4 THEN NULL WHEN userid % 37 = 5 THEN repeat(name, 20)
                    ELSE name END AS name,
               CASE WHEN userid % 41 = 6 THEN NULL WHEN userid % 43 = 7 THEN repeat(email, 20)
                    ELSE email END AS email
        FROM users
        UNION ALL SELECT userid, 'again', email FROM users WHERE userid % 47 = 8""",
    "raw_licenses": f"""
        SELECT CASE WHEN {_NUMBER} % 101 = 1 THEN NULL WHEN {_NUMBER} % 103 = 2 THEN '0'
                    ELSE license_id END AS license_id,
               CASE WHEN {_NUMBER} % 107 <> 3 THEN userid END AS userid,
               CASE WHEN {_NUMBER} % 109 = 4 THEN NULL WHEN {_NUMBER} % 113 = 5 THEN 'Type 9'
                    WHEN {_NUMBER} % 127 = 6 THEN repeat(license_type, 4)
                    ELSE license_type END AS license_type,
               CASE WHEN {_NUMBER} % 131 <> 7 THEN start_date END AS start_date,
               CASE WHEN {_NUMBER} % 137 = 8 THEN NULL WHEN {_NUMBER} % 139 = 9 THEN start_date
                    WHEN {_NUMBER} % 149 = 10 THEN CAST(start_date - 1 AS DATE)
                    ELSE expiry_date END AS expiry_date,
               CASE WHEN {_NUMBER} % 151 = 11 THEN NULL
                    WHEN {_NUMBER} % 157 = 12 THEN repeat(product_name, 30)
                    ELSE product_name END AS product_name,
               CASE WHEN {_NUMBER} % 163 = 13 THEN NULL WHEN {_NUMBER} % 167 = 14 THEN 'active'
                    WHEN {_NUMBER} % 173 = 15 THEN repeat(status, 6) ELSE status END AS status
        FROM licenses""",
    "raw_requests": """
        SELECT CASE WHEN id % 101 = 1 THEN NULL WHEN id % 103 = 2 THEN 0 ELSE id END AS id,
               CASE WHEN id % 107 <> 3 THEN userid END AS userid,
               CASE WHEN id % 109 = 4 THEN NULL WHEN id % 113 = 5 THEN 'pending'
                    WHEN id % 127 = 6 THEN repeat(request_status, 5)
                    ELSE request_status END AS request_status,
               CASE WHEN id % 131 = 7 THEN repeat('Type 1', 9) ELSE license_type END
                   AS license_type,
               CASE WHEN id % 137 = 8 THEN repeat(product_name, 30) ELSE product_name END
                   AS product_name
        FROM requests""",
}

_ACTIVE = f"status = 'ACTIVE' AND expiry_date >= {_DAY}"
_DUE = f"status = 'ACTIVE' AND expiry_date < {_DAY}"

# Steps that build on the base tables, in the order they depend on each other.
_STEPS = {
    "pending": "SELECT * FROM requests WHERE request_status = 'PENDING'",
    "active": f"SELECT * FROM licenses WHERE {_ACTIVE}",
    "decisions": """
        SELECT p.*, CASE
            WHEN NOT EXISTS (SELECT 1 FROM users u WHERE u.userid = p.userid)
                THEN 'REJECTED_UNKNOWN_USER'
            WHEN EXISTS (SELECT 1 FROM active a WHERE a.userid = p.userid
                         AND a.license_type = p.license_type
                         AND a.product_name = p.product_name) THEN 'REJECTED_DUPLICATE'
            ELSE 'APPROVED' END AS decision
        FROM pending p""",
    "granted": f"""
        SELECT {_license_id('id', 'requested_at', _DAY)} AS license_id,
               userid, license_type, {_DAY} AS start_date,
               CAST({_DAY} + CASE license_type WHEN 'Type 1' THEN 30 WHEN 'Type 2' THEN 90
                    WHEN 'Type 3' THEN 365 ELSE 30 END AS DATE) AS expiry_date,
               product_name, 'ACTIVE' AS status, {_NOW} AS created_at
        FROM decisions WHERE decision = 'APPROVED'""",
    "issued": """
        SELECT *, created_at AS updated_at FROM granted
        WHERE license_type IN ('Type 1', 'Type 2', 'Type 3') AND product_name IS NOT NULL""",
    "with_issued": "SELECT * FROM licenses UNION ALL BY NAME SELECT * FROM issued",
    "licenses_final": f"""
        SELECT * REPLACE (CASE WHEN {_DUE} THEN 'EXPIRED' ELSE status END AS status,
                          CASE WHEN {_DUE} THEN {_NOW} ELSE updated_at END AS updated_at)
        FROM with_issued""",
}


def _sql(body: str, **more: str) -> str:
    """``body`` after the CTEs it needs, directly or through one another."""
    steps = {**_BASE, **_RAW, **_STEPS, **more}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in steps:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(steps[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in steps.items() if name in needed)
    return f"WITH {ctes}\n{body}"


_COUNTS = "count(DISTINCT userid) AS unique_users, count(*) AS total_licenses"
_REQUEST = "id, userid, license_type, product_name, requested_at"
_SHOWN = f"CASE WHEN {_ACTIVE} THEN 'Active' WHEN {_DUE} THEN 'Expired' ELSE status END"


def _flags(licenses: str, expiry_test: str) -> str:
    return (
        f"EXISTS (SELECT 1 FROM {licenses} l WHERE l.userid = u.userid "
        f"AND l.status = 'ACTIVE' AND l.expiry_date {expiry_test} {_DAY})"
    )


def _refreshed(licenses: str) -> str:
    flag = _flags(licenses, ">=")
    return f"""
        SELECT * EXCLUDE (target) REPLACE (
            CASE WHEN islicenseactive <> target THEN target ELSE islicenseactive END
                AS islicenseactive,
            CASE WHEN islicenseactive <> target THEN {_NOW} ELSE updated_at END AS updated_at)
        FROM (SELECT u.*, {flag} AS target FROM users u)"""


def _decided(undecided: str = "FALSE") -> str:
    return f"""
        SELECT * FROM requests WHERE request_status <> 'PENDING'
        UNION ALL BY NAME
        SELECT * EXCLUDE (decision) REPLACE (
            CASE WHEN {undecided} THEN request_status
                 WHEN decision = 'APPROVED' THEN 'APPROVED' ELSE 'REJECTED' END AS request_status,
            CASE WHEN {undecided} THEN processed_at ELSE {_NOW} END AS processed_at)
        FROM decisions"""


def _report(licenses: str) -> str:
    return f"""
        SELECT 'active_' || CASE WHEN GROUPING(license_type) = 1 THEN 'total'
                    WHEN GROUPING(product_name) = 1 THEN 'type' ELSE 'type_product' END AS report,
               license_type, product_name, CAST(NULL AS VARCHAR) AS license_status, {_COUNTS}
        FROM {licenses} WHERE {_ACTIVE}
        GROUP BY GROUPING SETS ((license_type), (license_type, product_name), ())
        UNION ALL
        SELECT 'all_status', NULL, NULL, status, {_COUNTS} FROM {licenses} GROUP BY status
        UNION ALL
        SELECT 'all_type_status', license_type, NULL, {_SHOWN}, {_COUNTS}
        FROM {licenses} GROUP BY license_type, {_SHOWN}"""


def _count_rules(table: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"count(CASE WHEN {broken} THEN 1 END) AS violations FROM raw_{table}"
        for rule, broken in rules.items()
    )


def _nulls(*columns: str) -> dict[str, str]:
    return {f"{c} is null": f"{c} IS NULL" for c in columns}


def _lengths(**limits: int) -> dict[str, str]:
    return {
        f"{c} longer than {n}": f"length(CAST({c} AS VARCHAR)) > {n}" for c, n in limits.items()
    }


_EMAIL = "NOT regexp_matches(email, '(?i)^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}')"
_TYPE_RULE = {"license_type outside domain": "license_type NOT IN ('Type 1', 'Type 2', 'Type 3')"}
_DATE_RULE = {"expiry_date not after start_date": "NOT expiry_date > start_date"}
_STATUS_RULE = {
    "status outside domain": "status NOT IN ('ACTIVE', 'EXPIRED', 'SUSPENDED', 'REVOKED')"
}
_REQUEST_STATUS_RULE = {
    "request_status outside domain":
        "request_status NOT IN ('PENDING', 'APPROVED', 'REJECTED', 'PROCESSING', 'FAILED')"
}
_NULL_RULES = {
    "users": _nulls("userid", "name", "email"),
    "licenses": _nulls("license_id", "userid", "license_type", "start_date", "expiry_date",
                       "product_name", "status"),
    "requests": _nulls("id", "userid", "request_status"),
}
_LENGTH_RULES = {
    "users": _lengths(userid=50, name=255, email=255),
    "licenses": _lengths(userid=50, license_type=20, product_name=100, status=20),
    "requests": _lengths(userid=50, request_status=20, license_type=20, product_name=100),
}
_OWN_RULES = {
    "users": {"email malformed": _EMAIL},
    "licenses": {**_DATE_RULE, **_STATUS_RULE, **_TYPE_RULE},
    "requests": {**_TYPE_RULE, **_REQUEST_STATUS_RULE},
}


def _count_all(*groups: dict[str, dict[str, str]]) -> str:
    tables = ("users", "licenses", "requests")
    return "\nUNION ALL\n".join(
        _count_rules(table, {k: v for group in groups for k, v in group[table].items()})
        for table in tables
    )


def _key_count(table: str, key: str) -> str:
    return f"""
        SELECT '{table}' AS table_name,
               count(CASE WHEN {key} IS NOT NULL AND copies > 1 THEN 1 END) AS repeated_keys,
               CAST(coalesce(sum(CASE WHEN {key} IS NULL THEN copies ELSE 0 END), 0) AS BIGINT)
                   AS null_keys
        FROM (SELECT {key}, count(*) AS copies FROM raw_{table} GROUP BY {key})"""


def _by_type(where: str, keys: str = "license_type") -> str:
    return (
        f"SELECT {keys}, {_COUNTS} FROM licenses WHERE {where} GROUP BY {keys} ORDER BY {keys}"
    )


def _pick(column: str, slot: int, size: str) -> str:
    return f"(CAST('0x' || substr({column}, {slot * 7 + 1}, 7) AS BIGINT) % {size})"


def _named(column: str, slot: int, values: tuple[str, ...]) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST({_pick(column, slot, str(len(values)))} + 1 AS INTEGER)]"


def _generator_sql() -> dict[str, str]:
    def drawn(*labels: str) -> str:
        digests = ", ".join(
            f"md5('{SEED}:{label}:' || CAST(c_custkey + 1 AS VARCHAR)) AS d_{label}"
            for label in labels
        )
        return f"(SELECT c_custkey + 1 AS n, {digests} FROM customer)"

    created = f"TIMESTAMP '{AS_OF} 00:00:00'"
    key = f"md5('{SEED}:' || CAST(n AS VARCHAR))"
    first = _named("d_user", 0, generated.FIRST_NAMES)
    last = _named("d_user", 1, generated.LAST_NAMES)
    return {
        "gen_users": f"""
            SELECT CAST(n AS VARCHAR) AS userid, {first} || ' ' || {last} AS name,
                   lower({first}) || '.' || lower({last}) || '.' || CAST(n AS VARCHAR)
                       || '@example.org' AS email,
                   TIMESTAMP '{AS_OF.year}-01-01 00:00:00'
                       + to_seconds({_pick('d_user', 2, '86400')}) AS lastlogin,
                   {_pick('d_user', 3, '2')} = 1 AS islicenseactive,
                   {created} AS created_at, {created} AS updated_at
            FROM {drawn('user')}""",
        "gen_licenses": f"""
            SELECT substr({key}, 1, 8) || '-' || substr({key}, 9, 4) || '-'
                       || substr({key}, 13, 4) || '-' || substr({key}, 17, 4) || '-'
                       || substr({key}, 21, 12) AS license_id,
                   CAST(n AS VARCHAR) AS userid,
                   {_named('d_license', 0, ('Type 1', 'Type 2', 'Type 3'))} AS license_type,
                   CAST({_DAY} - CAST({_pick('d_dates', 0, '366')} AS INTEGER) AS DATE)
                       AS start_date,
                   CAST({_DAY} + CAST({_pick('d_dates', 1, '365')} AS INTEGER) + 1 AS DATE)
                       AS expiry_date,
                   {_named('d_license', 1, generated.PRODUCTS)} AS product_name,
                   {_named('d_license', 2, generated.STATUSES)} AS status,
                   {created} AS created_at, {created} AS updated_at
            FROM {drawn('license', 'dates')}""",
        "gen_requests": f"""
            SELECT n AS id, CAST(n AS VARCHAR) AS userid, 'PENDING' AS request_status,
                   {_named('d_request', 0, ('Type 1', 'Type 2', 'Type 3'))} AS license_type,
                   {_named('d_request', 1, generated.PRODUCTS)} AS product_name,
                   {created} AS requested_at, CAST(NULL AS TIMESTAMP) AS processed_at
            FROM {drawn('request')}""",
    }


def oracle_sql() -> dict[str, str]:
    found = library_sql()
    return found | llm_oracle.oracle_sql() if llm_oracle else found


def library_sql() -> dict[str, str]:
    exists = _flags("licenses", ">")
    bodies = {
        "pending_requests": f"SELECT {_REQUEST} FROM pending",
        "known_users": "SELECT userid FROM users",
        "active_licenses": "SELECT userid, license_type, product_name FROM active",
        "valid_requests": f"""
            SELECT {_REQUEST} FROM pending p
            WHERE EXISTS (SELECT 1 FROM users u WHERE u.userid = p.userid)""",
        "valid_requests_filtered": f"""
            SELECT {_REQUEST} FROM pending p
            WHERE EXISTS (SELECT 1 FROM users u WHERE u.userid = p.userid)""",
        "approved_requests": f"SELECT {_REQUEST} FROM decisions WHERE decision = 'APPROVED'",
        "rejected_requests": f"SELECT {_REQUEST} FROM decisions WHERE decision <> 'APPROVED'",
        "request_decisions_filtered": f"SELECT {_REQUEST}, decision FROM decisions",
        "request_decisions": f"SELECT {_REQUEST}, decision FROM decisions",
        "decision_counts":
            "SELECT decision, count(*) AS requests FROM decisions GROUP BY decision",
        "quarantined_requests": f"""
            SELECT {_REQUEST} FROM decisions WHERE decision = 'APPROVED'
            AND (license_type IS NULL OR product_name IS NULL)""",
        "new_licenses": "SELECT * FROM granted",
        "issue_licenses_table": "SELECT * FROM with_issued",
        "requests_after_decision": _decided(),
        "licenses_to_expire": f"SELECT license_id FROM licenses WHERE {_DUE}",
        "licenses_after_expiry": f"""
            SELECT * REPLACE (CASE WHEN {_DUE} THEN 'EXPIRED' ELSE status END AS status,
                              CASE WHEN {_DUE} THEN {_NOW} ELSE updated_at END AS updated_at)
            FROM licenses""",
        "license_expiry_changes": f"""
            SELECT license_id, 'EXPIRED' AS status, {_NOW} AS updated_at
            FROM licenses WHERE {_DUE}""",
        "user_license_rows": """
            SELECT u.userid, u.islicenseactive, l.license_id, l.license_type, l.status
            FROM users u LEFT JOIN licenses l ON u.userid = l.userid""",
        "user_license_outer": """
            SELECT u.userid, count(l.license_id) AS licenses
            FROM users u LEFT JOIN licenses l ON u.userid = l.userid GROUP BY u.userid""",
        "active_license_count_per_user": f"""
            SELECT userid, count(CASE WHEN {_ACTIVE} THEN 1 END) AS active_licenses,
                   count(*) AS licenses FROM licenses GROUP BY userid""",
        "user_status_drift": f"""
            SELECT u.userid, {_flags("licenses", ">=")} AS should_be_active FROM users u
            WHERE islicenseactive <> {_flags("licenses", ">=")}""",
        "user_status_drift_null_safe": f"""
            SELECT u.userid, {_flags("licenses", ">=")} AS should_be_active FROM users u
            WHERE islicenseactive IS DISTINCT FROM {_flags("licenses", ">=")}""",
        "user_status_drift_exclusive": f"""
            SELECT u.userid, {_flags("licenses", ">")} AS should_be_active FROM users u
            WHERE islicenseactive <> {_flags("licenses", ">")}""",
        "users_after_refresh": _refreshed("licenses"),
        "user_flag_exists": f"SELECT u.userid, {exists} AS islicenseactive FROM users u",
        "flag_refresh_for_touched_users": f"""
            SELECT * EXCLUDE (touched, target) REPLACE (
                CASE WHEN touched THEN target ELSE islicenseactive END AS islicenseactive,
                CASE WHEN touched THEN {_NOW} ELSE updated_at END AS updated_at)
            FROM (SELECT u.*, {exists} AS target,
                         EXISTS (SELECT 1 FROM licenses l
                                 WHERE l.userid = u.userid AND {_DUE}) AS touched
                  FROM users u)""",
        "cascade_delete_users": """
            SELECT * FROM users u WHERE NOT EXISTS (
                SELECT 1 FROM licenses r WHERE r.userid = u.userid AND r.status = 'REVOKED')""",
        "cascade_delete_licenses": """
            SELECT * FROM licenses l WHERE NOT EXISTS (
                SELECT 1 FROM licenses r WHERE r.userid = l.userid AND r.status = 'REVOKED')""",
        "cascade_rekey_users": """
            SELECT * REPLACE (CASE WHEN NOT islicenseactive THEN -userid - 1 ELSE userid END
                              AS userid) FROM users""",
        "cascade_rekey_licenses": """
            SELECT l.* REPLACE (coalesce(-u.userid - 1, l.userid) AS userid)
            FROM licenses l LEFT JOIN users u ON l.userid = u.userid AND NOT u.islicenseactive""",
        "license_counts_by_type": _by_type(_ACTIVE),
        "license_counts_by_type_product": _by_type(_ACTIVE, "license_type, product_name"),
        "license_counts_include_expired": _by_type("status = 'ACTIVE'"),
        "license_counts_by_type_product_include_expired": _by_type(
            "status = 'ACTIVE'", "license_type, product_name"),
        "license_counts_by_status": _by_type("TRUE", "status"),
        "license_expiry_breakdown": f"""
            SELECT license_type, {_SHOWN} AS license_status, {_COUNTS}
            FROM licenses GROUP BY license_type, {_SHOWN}""",
        "license_totals": f"""
            SELECT count(DISTINCT userid) AS total_unique_users, count(*) AS total_licenses
            FROM licenses WHERE {_ACTIVE}""",
        "license_totals_include_expired": """
            SELECT count(DISTINCT userid) AS total_unique_users, count(*) AS total_licenses
            FROM licenses WHERE status = 'ACTIVE'""",
        "license_distribution": """
            SELECT license_type, count(DISTINCT userid) AS user_count,
                   count(*) AS total_licenses
            FROM licenses WHERE status = 'ACTIVE' GROUP BY license_type""",
        "license_counts_grouping_sets": f"""
            SELECT license_type, product_name,
                   CASE WHEN GROUPING(license_type) = 1 THEN 'total'
                        WHEN GROUPING(product_name) = 1 THEN 'type'
                        ELSE 'type_product' END AS level, {_COUNTS}
            FROM licenses WHERE {_ACTIVE}
            GROUP BY GROUPING SETS ((license_type), (license_type, product_name), ())""",
        "license_report": _report("licenses"),
        "insert_ignore_users": f"""
            SELECT * FROM users
            UNION ALL BY NAME
            SELECT userid, name, email, lastlogin, islicenseactive, created_at, updated_at
            FROM (SELECT r.userid, 'Requester ' || CAST(r.id AS VARCHAR) AS name,
                         'r' || CAST(r.id AS VARCHAR) || '@example.org' AS email,
                         r.requested_at AS lastlogin, FALSE AS islicenseactive,
                         {_NOW} AS created_at, {_NOW} AS updated_at,
                         row_number() OVER (PARTITION BY r.userid
                                            ORDER BY r.requested_at, r.id) AS place
                  FROM requests r
                  WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.userid = r.userid))
            WHERE place = 1""",
        "request_defaults": f"""
            SELECT id, CAST(userid AS VARCHAR) AS userid, request_status, license_type,
                   product_name,
                   CASE WHEN request_status = 'PENDING' THEN {_NOW} ELSE requested_at END
                       AS requested_at,
                   CAST(NULL AS TIMESTAMP) AS processed_at
            FROM requests""",
        "user_defaults": f"""
            SELECT userid, name, email,
                   CAST(NULL AS TIMESTAMP) AS lastlogin,
                   coalesce(islicenseactive, FALSE) AS islicenseactive,
                   {_NOW} AS created_at, {_NOW} AS updated_at FROM users""",
        "license_defaults": f"""
            SELECT {_uuid(_BARE_KEY)} AS license_id, userid,
                   license_type, start_date, expiry_date, product_name, 'ACTIVE' AS status,
                   {_NOW} AS created_at, {_NOW} AS updated_at FROM licenses""",
        "reissued_licenses": f"""
            SELECT * FROM granted
            UNION ALL
            SELECT * EXCLUDE (id, requested_at) REPLACE (
                              {_license_id('id', 'requested_at', _LATER)} AS license_id,
                              {_LATER} AS start_date,
                              CAST(expiry_date + 365 AS DATE) AS expiry_date)
            FROM (SELECT d.id, d.requested_at, g.* FROM decisions d JOIN granted g
                  ON g.license_id = {_license_id('d.id', 'd.requested_at', _DAY)})""",
        "dq_duplicate_keys": "\nUNION ALL\n".join((
            _key_count("users", "userid"),
            _key_count("licenses", "license_id"),
            _key_count("requests", "id"),
        )),
        "dq_duplicate_email":
            "SELECT email, count(*) AS copies FROM users GROUP BY email HAVING count(*) > 1",
        "dq_nulls": _count_all(_NULL_RULES),
        "dq_bad_email":
            f"SELECT userid, email, 'email malformed' AS rule FROM users WHERE {_EMAIL}",
        "dq_bad_dates": _count_rules("licenses", _DATE_RULE),
        "dq_bad_license_status": _count_rules("licenses", _STATUS_RULE),
        "dq_bad_license_type": _count_rules("licenses", _TYPE_RULE)
            + "\nUNION ALL\n" + _count_rules("requests", _TYPE_RULE),
        "dq_bad_request_status": _count_rules("requests", _REQUEST_STATUS_RULE),
        "dq_length": _count_all(_LENGTH_RULES),
        "dq_orphan_licenses": """
            SELECT license_id, userid FROM licenses l
            WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.userid = l.userid)""",
        "dq_report": _count_all(_NULL_RULES, _OWN_RULES, _LENGTH_RULES),
        "pipeline_report": _report("licenses_final"),
        "pipeline_licenses": "SELECT * FROM licenses_final",
        "pipeline_requests": _decided(
            "decision = 'APPROVED' AND (license_type IS NULL OR product_name IS NULL)"),
        "pipeline_users": _refreshed("licenses_final"),
        "running_license_report": _report("licenses_final"),
        "near_license_counts": f"""
            SELECT CASE WHEN GROUPING(license_type) = 1 THEN 'total'
                        WHEN GROUPING(product_name) = 1 THEN 'type'
                        ELSE 'type_product' END AS level,
                   license_type, product_name, {_COUNTS}, TRUE AS users_near
            FROM licenses WHERE {_ACTIVE}
            GROUP BY GROUPING SETS ((license_type), (license_type, product_name), ())""",
        "arriving_known_users": """
            SELECT userid FROM requests r GROUP BY userid
            HAVING count(*) > 1 OR userid IN (SELECT userid FROM users)""",
        "license_numbers": """
            SELECT license_id, start_date,
                   row_number() OVER (ORDER BY start_date, license_id) AS license_no
            FROM licenses""",
    }
    bodies |= {
        "licenses_expired_in_place": bodies["licenses_after_expiry"],
        **{f"in_place_{name}": bodies[f"pipeline_{name}"]
           for name in ("licenses", "requests", "users")},
        "sql_licenses_due": bodies["licenses_to_expire"],
        "sql_active_seats": bodies["active_licenses"],
        "sql_license_counts": bodies["license_counts_by_type"],
        "sql_flag_drift": bodies["user_status_drift"],
        "sql_approved_requests": bodies["approved_requests"],
    }
    return {
        **{name: _sql(body) for name, body in bodies.items()},
        **_generator_sql(),
    }
