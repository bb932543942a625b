"""JDBC options, and the database jobs with DuckDB standing in for the databases.

Spark's own JDBC reads and writes are replaced: the tests hand rows over directly
and run the jobs' SQL statements unchanged.
"""

import duckdb
import pytest
import seed as known
from seed import AS_OF, NOW, license_rows, request_rows, seed_tables, user_rows

from seatwise.plans import database as jobs
from seatwise.plans.jobs import license_report, plan_pipeline
from seatwise.schemas import LICENSES, REQUESTS, USERS
from seatwise.sinks import jdbc as sink
from seatwise.sources import jdbc as source

DATABASE = source.Database("jdbc:postgresql://host/db", "me", "secret")


class Recorder:
    """Stands in for a session, reader or writer and keeps what it is told."""

    def __init__(self):
        self.seen = {}

    def __getattr__(self, name):
        if name in ("read", "write"):
            return self

        def call(*args, **options):
            if name == "options":
                self.seen.update(options)
            elif args:
                self.seen[name] = args[0]
            return self

        return call


def test_table_read_options():
    spark = Recorder()
    source.read_table(spark, DATABASE, "licenses", source.Split("expiry_date", "2020-01-01", "2026-01-01", 64))
    assert spark.seen == {
        "format": "jdbc", "url": "jdbc:postgresql://host/db", "user": "me", "password": "secret",
        "driver": "org.postgresql.Driver", "fetchsize": "10000", "batchsize": "10000",
        "preferTimestampNTZ": "true", "dbtable": "licenses", "partitionColumn": "expiry_date",
        "lowerBound": "2020-01-01", "upperBound": "2026-01-01", "numPartitions": "64"}


def test_query_read_options():
    spark = Recorder()
    source.read_query(spark, DATABASE, "SELECT 1 AS probe")
    assert spark.seen["query"] == "SELECT 1 AS probe" and "dbtable" not in spark.seen


def test_write_options():
    rows = Recorder()
    sink.stage(rows, DATABASE, "licenses_staged", connections=8)
    assert rows.seen["mode"] == "overwrite" and rows.seen["numPartitions"] == "8"
    assert rows.seen["dbtable"] == "licenses_staged" and rows.seen["truncate"] == "true"
    sink.append_table(rows, DATABASE, "licenses")
    assert rows.seen["mode"] == "append"


def test_password_stays_out_of_printed_settings():
    assert "secret" not in repr(DATABASE)


def test_names_are_checked():
    with pytest.raises(ValueError):
        sink.insert_statement("licenses; DROP TABLE users", "s", ["id"], "id")
    with pytest.raises(ValueError):
        sink.update_statement("t", "s", ["a b"], "id")


class Connection:
    """DuckDB behind the DB-API calls the jobs make."""

    def __init__(self, base, fail_on=None):
        self.base, self.fail_on, self.rowcount = base, fail_on, -1
        base.execute("BEGIN")

    def cursor(self):
        return self

    def execute(self, statement):
        if self.fail_on and self.fail_on in statement:
            raise RuntimeError("connection lost")
        self.rowcount = self.base.execute(statement).fetchall()[0][0]

    def commit(self):
        self.base.execute("COMMIT")

    def rollback(self):
        self.base.execute("ROLLBACK")

    def close(self):
        pass


@pytest.fixture
def base():
    connection = duckdb.connect()
    connection.execute("""
        CREATE TABLE users (userid VARCHAR PRIMARY KEY, name VARCHAR NOT NULL,
            email VARCHAR NOT NULL, lastlogin TIMESTAMP, islicenseactive BOOLEAN,
            created_at TIMESTAMP, updated_at TIMESTAMP);
        CREATE TABLE licenses (license_id UUID PRIMARY KEY, userid VARCHAR NOT NULL,
            license_type VARCHAR NOT NULL, start_date DATE NOT NULL, expiry_date DATE NOT NULL,
            product_name VARCHAR NOT NULL, status VARCHAR NOT NULL,
            created_at TIMESTAMP, updated_at TIMESTAMP DEFAULT TIMESTAMP '2025-09-10 07:00:00');
        CREATE TABLE requests (id BIGINT PRIMARY KEY, userid VARCHAR NOT NULL,
            request_status VARCHAR NOT NULL, license_type VARCHAR, product_name VARCHAR,
            requested_at TIMESTAMP, processed_at TIMESTAMP);
    """)
    for table, rows in (("users", user_rows()), ("licenses", license_rows()), ("requests", request_rows())):
        marks = ", ".join("?" * len(rows[0]))
        connection.executemany(f"INSERT INTO {table} VALUES ({marks})", rows)
    return connection


@pytest.fixture
def handed_over(monkeypatch, base):
    """Reads and staging writes go straight to the stand-in database; every staged
    row arrives twice, as after a retried task."""
    schemas = {"users": USERS, "licenses": LICENSES, "requests": REQUESTS}
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "date": "DATE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}

    def read_table(spark, database, table, split=None, one_task=False):
        columns = ", ".join(
            f"CAST({f.name} AS VARCHAR) AS {f.name}" if f.name == "license_id" else f.name
            for f in schemas[table])
        rows = base.execute(f"SELECT {columns} FROM {table}").fetchall()
        return spark.createDataFrame(rows, schemas[table])

    def stage(rows, database, table, connections=32):
        columns = ", ".join(f"{f.name} {kinds[f.dataType.simpleString()]}" for f in rows.schema)
        base.execute(f"CREATE OR REPLACE TABLE {table} ({columns})")
        data = [tuple(r) for r in rows.collect()] * 2
        if data:
            base.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(data[0]))})", data)

    monkeypatch.setattr(source, "read_table", read_table)
    monkeypatch.setattr(sink, "stage", stage)


def places(base, fail_on=None):
    def place(table):
        return jobs.Place(DATABASE, table, lambda: Connection(base, fail_on))

    return jobs.Places(users=place("users"), licenses=place("licenses"), requests=place("requests"))


def statuses(base):
    return dict(base.execute("SELECT request_status, count(*) FROM requests GROUP BY 1").fetchall())


def test_issuing_does_not_turn_approvals_into_rejections(spark, base, handed_over):
    result = jobs.request_job(spark, places(base), AS_OF, NOW)
    assert result == {"licenses_issued": known.ISSUED, "requests_updated": known.ISSUED}
    assert statuses(base) == known.REQUESTS_AFTER
    assert base.execute("SELECT count(*) FROM licenses").fetchall() == [(known.LICENSES_AFTER,)]
    assert jobs.request_job(spark, places(base), AS_OF, NOW) == {
        "licenses_issued": 0, "requests_updated": 0}


def test_interrupted_request_job_can_be_repeated(spark, base, handed_over):
    with pytest.raises(RuntimeError, match="connection lost"):
        jobs.request_job(spark, places(base, fail_on="UPDATE requests"), AS_OF, NOW)
    assert base.execute("SELECT count(*) FROM licenses").fetchall() == [(known.LICENSES_AFTER,)]
    assert statuses(base)["PENDING"] == known.ISSUED
    assert jobs.request_job(spark, places(base), AS_OF, NOW) == {
        "licenses_issued": 0, "requests_updated": known.ISSUED}
    assert statuses(base) == known.REQUESTS_AFTER
    assert base.execute("SELECT count(*) FROM licenses").fetchall() == [(known.LICENSES_AFTER,)]


def test_failed_statement_rolls_back(spark, base, handed_over):
    connect = lambda: Connection(base, fail_on="second")
    with pytest.raises(RuntimeError):
        sink.apply_statements(connect, ["DELETE FROM requests", "second"])
    assert base.execute("SELECT count(*) FROM requests").fetchall() == [(len(request_rows()),)]


def test_expiry_job(spark, base, handed_over):
    assert jobs.expiry_job(spark, places(base), AS_OF, NOW) == {
        "licenses_expired": known.DUE, "users_updated": len(known.FLAGS_OFF)}
    assert base.execute(
        "SELECT count(*) FROM licenses WHERE status = 'EXPIRED' AND updated_at = TIMESTAMP '2025-09-10 07:00:00'"
    ).fetchall() == [(known.DUE,)]
    assert base.execute("SELECT count(*) FROM users WHERE islicenseactive").fetchall() == [(len(known.HOLDERS),)]
    assert jobs.expiry_job(spark, places(base), AS_OF, NOW) == {
        "licenses_expired": 0, "users_updated": 0}


def test_jobs_leave_the_same_state_as_the_table_pipeline(spark, base, handed_over):
    jobs.request_job(spark, places(base), AS_OF, NOW)
    jobs.expiry_job(spark, places(base), AS_OF, NOW)
    after = plan_pipeline(seed_tables(spark), AS_OF, NOW).tables
    for name, rows in after.items():
        columns = ", ".join(
            f"CAST({c} AS VARCHAR)" if c == "license_id" else c for c in rows.columns)
        stored = base.execute(f"SELECT {columns} FROM {name}").fetchall()
        assert sorted(stored, key=repr) == sorted((tuple(r) for r in rows.collect()), key=repr)


def test_whole_pipeline(spark, base, handed_over, monkeypatch):
    probed = []

    def read_query(spark, database, query):
        probed.append(database.url)
        return spark.range(1)

    monkeypatch.setattr(source, "read_query", read_query)
    affected, results = jobs.run_database_pipeline(spark, places(base), AS_OF, NOW)
    # the row trigger that flags users on insert is the database's; here the new
    # holders are found by the expiry job
    assert affected == {
        "licenses_issued": known.ISSUED, "requests_updated": known.ISSUED,
        "licenses_expired": known.DUE, "users_updated": known.FLAGS_CHANGED}
    assert probed == ["jdbc:postgresql://host/db"]
    assert [tuple(r) for r in results["by_status"].collect()] == known.STATUS_AFTER
    assert [tuple(r) for r in results["decision_counts"].collect()] == [("APPROVED", known.ISSUED)]
    wanted = plan_pipeline(seed_tables(spark), AS_OF, NOW).requests_run.distribution()
    assert sorted(map(tuple, results["distribution"].collect())) == sorted(map(tuple, wanted.collect()))


def test_whole_pipeline_in_brief_and_with_expired(spark, base, handed_over, monkeypatch):
    monkeypatch.setattr(source, "read_query", lambda spark, database, query: spark.range(1))
    _, results = jobs.run_database_pipeline(
        spark, places(base), AS_OF, NOW, include_expired=True, brief=True)
    assert set(results) == {"by_type", "totals", "decision_counts", "distribution"}
    after = plan_pipeline(seed_tables(spark), AS_OF, NOW).licenses_after
    wanted = license_report(after, AS_OF, include_expired=True, detailed=False)
    for name in ("by_type", "totals"):
        assert list(map(tuple, results[name].collect())) == list(map(tuple, wanted[name].collect()))


def test_a_taken_id_stops_the_job_before_it_changes_anything(spark, base, handed_over):
    jobs.request_job(spark, places(base), AS_OF, NOW)
    before = base.execute("SELECT * FROM licenses ORDER BY 1").fetchall()
    # revoked, and asked for again on the same day: the license's id would be the same
    base.execute("UPDATE licenses SET status = 'EXPIRED'")
    base.execute("UPDATE requests SET request_status = 'PENDING' WHERE processed_at IS NOT NULL")
    with pytest.raises(ValueError, match="issued already"):
        jobs.request_job(spark, places(base), AS_OF, NOW)
    assert statuses(base).get("PENDING", 0) > 0
    assert len(before) == base.execute("SELECT count(*) FROM licenses").fetchone()[0]
