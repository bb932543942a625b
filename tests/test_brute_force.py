"""The jobs on random small tables against a plain Python account of the rules."""

import datetime as dt
import random

import pytest
from rows import AS_OF, NOW, OLD, licenses, requests, users

from seatwise.operators import expiry, quality, reports
from seatwise.operators import requests as request_ops
from seatwise.plans.jobs import plan_pipeline
from seatwise.sources.tables import Tables

TYPES = ["Type 1", "Type 2", "Type 3"]
TERMS = {"Type 1": 30, "Type 2": 90, "Type 3": 365}


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(spark, request):
    draw = random.Random(request.param)
    people = [(f"u{i}", draw.choice([True, False, None])) for i in range(40)]

    def holder():
        # a third of the rows belong to one user; some users do not exist
        return "u0" if draw.random() < 0.33 else f"u{draw.randrange(50)}"

    held = [
        (f"l{i}", holder(), draw.choice(TYPES), draw.choice("ABC"),
         draw.choice(["ACTIVE", "ACTIVE", "EXPIRED", "SUSPENDED", "active"]),
         AS_OF + dt.timedelta(days=draw.randrange(-3, 4)))
        for i in range(300)
    ]
    asked = [
        (i, holder(), draw.choice(["PENDING", "PENDING", "APPROVED", "pending"]),
         draw.choice([*TYPES, None]), draw.choice(["A", "B", "C", "D", None]))
        for i in range(400)
    ]
    tables = Tables(users(spark, *people), licenses(spark, *held), requests(spark, *asked))
    return people, held, asked, tables


def active(row):
    return row[4] == "ACTIVE" and row[5] >= AS_OF


def decisions(people, held, asked):
    known = {u for u, _ in people}
    seats = {row[1:4] for row in held if active(row)}
    return {
        i: request_ops.UNKNOWN_USER if user not in known
        else request_ops.DUPLICATE if (user, kind, product) in seats
        else request_ops.APPROVED
        for i, user, status, kind, product in asked if status == "PENDING"
    }


def test_decisions(case):
    people, held, asked, tables = case
    wanted = decisions(people, held, asked)
    decided = request_ops.decide(tables.requests, tables.users, tables.licenses, AS_OF)
    assert {r.id: r.decision for r in decided.collect()} == wanted
    args = (tables.requests, tables.users, tables.licenses, AS_OF)
    approved = {i for i, d in wanted.items() if d == request_ops.APPROVED}
    assert {r.id for r in request_ops.approved_requests(*args).collect()} == approved
    assert {r.id for r in request_ops.rejected_requests(*args).collect()} == set(wanted) - approved


def test_drift_and_touched(spark, case):
    people, held, _, tables = case
    for inclusive in (True, False):
        holders = {
            row[1] for row in held
            if row[4] == "ACTIVE" and (row[5] >= AS_OF if inclusive else row[5] > AS_OF)
        }
        drift = expiry.flag_drift(tables.users, tables.licenses, AS_OF, inclusive)
        assert {tuple(r) for r in drift.collect()} == {
            (u, u in holders) for u, flag in people
            if flag is not None and flag != (u in holders)}
        touched = spark.createDataFrame([(f"u{i}",) for i in range(0, 50, 3)], ["userid"])
        after = expiry.refresh_touched(
            tables.users, tables.licenses, touched, AS_OF, NOW, inclusive)
        assert {(r.userid, r.islicenseactive, r.updated_at) for r in after.collect()} == {
            (u, u in holders, NOW) if int(u[1:]) % 3 == 0 else (u, flag, OLD)
            for u, flag in people}


def test_pipeline(case):
    people, held, asked, tables = case
    decided = decisions(people, held, asked)
    by_id = {row[0]: row for row in asked}
    issued = [
        (by_id[i][1], by_id[i][3], by_id[i][4]) for i, d in decided.items()
        if d == request_ops.APPROVED and by_id[i][3] and by_id[i][4]
    ]
    after = plan_pipeline(tables, AS_OF, NOW).tables

    wanted = sorted(
        [(u, k, p, "EXPIRED" if s == "ACTIVE" and e < AS_OF else s, e) for _, u, k, p, s, e in held]
        + [(u, k, p, "ACTIVE", AS_OF + dt.timedelta(days=TERMS[k])) for u, k, p in issued])
    found = after.licenses.select("userid", "license_type", "product_name", "status", "expiry_date")
    assert sorted(tuple(r) for r in found.collect()) == wanted

    outcome = {}
    for i, _, status, kind, product in asked:
        if status == "PENDING" and decided[i] != request_ops.APPROVED:
            status = "REJECTED"
        elif status == "PENDING" and kind and product:
            status = "APPROVED"
        outcome[i] = status
    rows = after.requests.collect()
    assert len(rows) == len(asked)
    assert {r.id: r.request_status for r in rows} == outcome

    holders = {row[1] for row in held if active(row)} | {u for u, _, _ in issued}
    assert {r.userid: r.islicenseactive for r in after.users.collect()} == {
        u: None if flag is None else u in holders for u, flag in people}


def test_counts_and_orphans(case):
    people, held, _, tables = case
    rows = [row for row in held if active(row)]
    total = reports.totals(tables.licenses, AS_OF).first()
    assert tuple(total) == (len({r[1] for r in rows}), len(rows))
    known = {u for u, _ in people}
    orphans = quality.orphan_licenses(tables.licenses, tables.users)
    assert {r.license_id for r in orphans.collect()} == {
        row[0] for row in held if row[1] not in known}
    paired = expiry.user_licenses(
        tables.users.select("userid"), tables.licenses.select("userid", "license_id"))
    owners = {row[1] for row in held}
    assert sorted((tuple(r) for r in paired.collect()), key=repr) == sorted(
        [(row[1], row[0]) for row in held if row[1] in known]
        + [(u, None) for u in known - owners], key=repr)
