"""The derived tables against plain Python over the source rows."""

from collections import Counter

import duckdb
import pytest

from seatwise.operators import expiry, quality, requests
from seatwise.sources.star import AS_OF, UNKNOWN, StarTables

DAYS = (30, 90, 365)


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def case(spark, request):
    folder = f"/root/testdata/{request.param}"
    rows = lambda sql: duckdb.sql(sql.format(folder)).fetchall()
    customers = rows("SELECT c_custkey, c_acctbal FROM '{}/customer.parquet'")
    licenses = []
    for key, user, status, day, product in rows(
            "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE), "
            "o_orderpriority FROM '{}/orders.parquet'"):
        left = (AS_OF - day).days
        licenses.append((user + UNKNOWN * (key % 11 == 7), f"Type {key % 3 + 1}", product,
                         status == "O", DAYS[key % 3] - left))
    names = {"click": "1-URGENT", "view": "2-HIGH", "error": "3-MEDIUM",
             "signup": "4-NOT SPECIFIED", "purchase": "5-LOW"}
    asked = [(user + UNKNOWN * (key % 11 == 7), f"Type {key % 4 + 1}" if key % 4 < 3 else None,
              names.get(kind)) for key, user, kind in
             rows("SELECT event_id, user_id, event_type FROM '{}/events.parquet'") if key % 5 < 3]
    return StarTables(spark, folder), customers, licenses, asked


def test_every_customer_is_a_user(case):
    tables, customers, licenses, _ = case
    assert tables.users.count() == len(customers)
    users = {key for key, _ in customers}
    orphans = quality.orphan_licenses(tables.licenses, tables.users).count()
    assert orphans == sum(user not in users for user, *_ in licenses) > 0


def test_decisions(case):
    tables, customers, licenses, asked = case
    users = {key for key, _ in customers}
    held = {row[:3] for row in licenses if row[3] and row[4] >= 0}
    wanted = Counter(requests.UNKNOWN_USER if r[0] not in users else
                     requests.DUPLICATE if r in held else requests.APPROVED for r in asked)
    decided = requests.decide(tables.requests, tables.users, tables.licenses, AS_OF)
    found = {r.decision: r.requests for r in requests.decision_counts(decided).collect()}
    assert found == wanted and set(wanted) == {
        requests.UNKNOWN_USER, requests.DUPLICATE, requests.APPROVED}


def test_expiry_and_drift(case):
    tables, customers, licenses, _ = case
    assert expiry.licenses_to_expire(tables.licenses, AS_OF).count() == sum(
        row[3] and row[4] < 0 for row in licenses)
    active = {row[0] for row in licenses if row[3] and row[4] >= 0}
    wanted = {key for key, balance in customers
              if key % 10 != 8 and (balance > 5000) != (key in active)}
    drift = expiry.flag_drift(tables.users, tables.licenses, AS_OF)
    assert {r.userid for r in drift.collect()} == wanted


def test_every_rule_is_broken_by_some_raw_rows(case):
    tables = case[0]
    # A number is never too long, and only the larger table has all of the rest.
    quiet = {"userid longer than 50"}
    for name, rows in tables.raw.items():
        for row in quality.rule_counts(rows, quality.rules_for(name), name).collect():
            assert row.rule in quiet or row.violations > 0, (name, row)
