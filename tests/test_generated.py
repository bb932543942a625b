import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import values

from seatwise.operators import quality, reports, requests
from seatwise.plans.jobs import plan_pipeline
from seatwise.schemas import BY_NAME, mismatches
from seatwise.sources.generated import generate_tables, user_ids

AS_OF = dt.date(2025, 9, 10)
COUNT = 3000


@pytest.fixture(scope="module")
def tables(spark):
    return generate_tables(user_ids(spark, COUNT, 5), AS_OF, seed=3)


def test_schema_and_constraints_hold(tables):
    for name, rows in tables.items():
        assert rows.count() == COUNT
        assert mismatches(rows.schema, BY_NAME[name]) == []
        broken = quality.rule_counts(rows, quality.rules_for(name), name)
        assert broken.filter("violations > 0").isEmpty()
    assert quality.repeated_keys(tables.users, "email").isEmpty()
    assert quality.repeated_keys(tables.licenses, "license_id").isEmpty()
    assert quality.orphan_licenses(tables.licenses, tables.users).isEmpty()


def test_layout_does_not_change_rows(spark, tables):
    other = generate_tables(user_ids(spark, COUNT, 2), AS_OF, seed=3)
    for (_, one), (_, two) in zip(tables.items(), other.items(), strict=True):
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_seed_changes_rows(spark, tables):
    other = generate_tables(user_ids(spark, COUNT, 2), AS_OF, seed=4)
    assert not tables.licenses.exceptAll(other.licenses).isEmpty()


def test_values_spread_over_their_ranges(tables):
    types = {r["license_type"]: r["count"] for r in tables.licenses.groupBy("license_type").count().collect()}
    assert set(types) == {"Type 1", "Type 2", "Type 3"} and min(types.values()) > COUNT * 0.28
    low, high, first, last = tables.licenses.agg(
        F.min("start_date"), F.max("start_date"), F.min("expiry_date"), F.max("expiry_date")).first()
    assert AS_OF - dt.timedelta(days=366) < low and high <= AS_OF
    assert AS_OF < first and last <= AS_OF + dt.timedelta(days=365)
    earliest, latest = tables.users.agg(F.min("lastlogin"), F.max("lastlogin")).first()
    assert dt.datetime(2025, 1, 1) <= earliest and latest < dt.datetime(2025, 9, 10)


def test_pipeline_invariants(tables):
    run = plan_pipeline(tables, AS_OF, "2025-09-10 07:00:00")
    pending = requests.pending_requests(tables.requests).count()
    assert run.requests_run.decisions.count() == pending == COUNT
    by_decision = dict(values(requests.decision_counts(run.requests_run.decisions)))
    assert sum(by_decision.values()) == COUNT and requests.UNKNOWN_USER not in by_decision
    after = run.tables
    assert after.licenses.count() == COUNT + by_decision[requests.APPROVED]
    flags = after.users.join(
        after.licenses.filter("status = 'ACTIVE' AND expiry_date >= DATE '2025-09-10'")
        .select("userid").distinct().withColumn("held", F.lit(True)), "userid", "left")
    assert flags.filter(F.col("islicenseactive") != F.coalesce("held", F.lit(False))).isEmpty()
    assert reports.totals(after.licenses, AS_OF).first()[0] == flags.filter("held").count()
