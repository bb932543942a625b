import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from rows import AFTER, AS_OF, BEFORE, NOW, ON, licenses, requests, users, values

from seatwise.operators import requests as ops
from seatwise.operators.matching import having_match, mark_match
from seatwise.plans.jobs import process_requests
from seatwise.sources.tables import Tables


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(
        users=users(spark, ("ann", True), ("bob", False), ("cat", None)),
        licenses=licenses(
            spark,
            ("l1", "ann", "Type 1", "A", "ACTIVE", ON),
            ("l2", "ann", "Type 1", "A", "ACTIVE", AFTER),
            ("l3", "ann", "Type 2", "A", "ACTIVE", BEFORE),
            ("l4", "bob", "Type 1", "A", "EXPIRED", AFTER),
            ("l5", "bob", "Type 2", "A", "active", AFTER),
            ("l6", "zed", "Type 1", "A", "ACTIVE", AFTER),
        ),
        requests=requests(
            spark,
            (1, "ann", "PENDING", "Type 1", "A"),     # held twice, one license ends today
            (2, "ann", "PENDING", "Type 2", "A"),     # held license ended yesterday
            (3, "bob", "PENDING", "Type 1", "A"),     # held license is EXPIRED
            (4, "bob", "PENDING", "Type 2", "A"),     # held license is lower case
            (5, "cat", "PENDING", None, "A"),         # no type
            (6, "cat", "PENDING", "Type 1", None),    # no product
            (7, "zed", "PENDING", "Type 1", "A"),     # unknown user, though licensed
            (8, "Ann", "PENDING", "Type 3", "A"),     # user id in another case
            (9, "cat", "PENDING", "Type 3", "B"),     # asked for twice
            (10, "cat", "PENDING", "Type 3", "B"),
            (11, "ann", "pending", "Type 3", "B"),    # status in lower case
            (12, "ann", "PROCESSING", "Type 3", "B"),
            (13, "cat", "PENDING", "Type 9", "B"),    # type outside the domain
        ),
    )


APPROVED_IDS = [2, 3, 4, 5, 6, 9, 10, 13]


def ids(rows):
    return sorted(r.id for r in rows.select("id").collect())


def test_pending_is_case_sensitive(tables):
    assert ids(ops.pending_requests(tables.requests)) == [*range(1, 11), 13]


def test_active_seats_include_the_expiry_day(tables):
    assert values(ops.active_seats(tables.licenses, AS_OF)) == [
        ("ann", "Type 1", "A"), ("ann", "Type 1", "A"), ("zed", "Type 1", "A")]


def test_valid_requests(tables):
    assert ids(ops.valid_requests(tables.requests, tables.users)) == [1, 2, 3, 4, 5, 6, 9, 10, 13]


def test_approved_and_rejected_split_the_pending(tables):
    args = (tables.requests, tables.users, tables.licenses, AS_OF)
    assert ids(ops.approved_requests(*args)) == APPROVED_IDS
    assert ids(ops.rejected_requests(*args)) == [1, 7, 8]


def test_decisions_agree_with_the_separate_joins(tables):
    decided = ops.decide(tables.requests, tables.users, tables.licenses, AS_OF)
    by_id = {r.id: r.decision for r in decided.collect()}
    assert [i for i, d in sorted(by_id.items()) if d == ops.APPROVED] == APPROVED_IDS
    assert by_id[1] == ops.DUPLICATE
    assert by_id[7] == by_id[8] == ops.UNKNOWN_USER
    assert dict(values(ops.decision_counts(decided))) == {
        ops.APPROVED: 8, ops.DUPLICATE: 1, ops.UNKNOWN_USER: 2}


def test_repeated_keys_do_not_multiply_rows(tables):
    twice = tables.users.unionByName(tables.users)
    valid = ops.valid_requests(tables.requests, tables.users)
    assert values(ops.valid_requests(tables.requests, twice)) == values(valid)
    for unique in (mark_match(valid, twice, ["userid"], "known"),
                   having_match(valid, twice, ["userid"])):
        assert unique.count() == valid.count()


def test_new_licenses_run_for_their_term(spark):
    approved = requests(
        spark, (1, "u", "PENDING", "Type 1", "A"), (2, "u", "PENDING", "Type 2", "A"),
        (3, "u", "PENDING", "Type 3", "A"), (4, "u", "PENDING", None, "A"),
        (5, "u", "PENDING", "Type 9", "A"))
    rows = ops.new_licenses(approved, AS_OF, NOW).collect()
    assert [(r.expiry_date - r.start_date).days for r in rows] == [30, 90, 365, 30, 30]
    assert {r.status for r in rows} == {"ACTIVE"}
    assert {r.start_date for r in rows} == {AS_OF}
    assert {r.created_at for r in rows} == {NOW}


def test_license_ids_are_uuids_and_repeat(tables):
    approved = ops.approved_requests(tables.requests, tables.users, tables.licenses, AS_OF)
    first = values(ops.new_licenses(approved, AS_OF, NOW), "license_id")
    again = values(ops.new_licenses(approved.repartition(5), AS_OF, NOW), "license_id")
    assert first == again and len(set(first)) == len(APPROVED_IDS)
    assert all(str(uuid.UUID(i)) == i for (i,) in first)
    drawn = values(ops.new_licenses(approved, AS_OF, NOW, random_ids=True), "license_id")
    assert len(set(drawn)) == len(APPROVED_IDS) and not set(drawn) & set(first)


def test_status_update_keeps_other_rows(tables):
    decided = ops.decide(tables.requests, tables.users, tables.licenses, AS_OF)
    after = {r.id: r for r in ops.apply_decisions(tables.requests, decided, NOW).collect()}
    assert len(after) == 13
    assert after[11].request_status == "pending" and after[11].processed_at is None
    assert after[12].request_status == "PROCESSING" and after[12].processed_at is None
    assert after[1].request_status == "REJECTED" and after[1].processed_at == NOW
    assert after[2].request_status == "APPROVED" and after[2].processed_at == NOW


def test_job_holds_back_what_the_license_table_refuses(tables):
    run = process_requests(tables, AS_OF, NOW)
    assert ids(run.quarantined) == [5, 6, 13]
    assert run.new_licenses.count() == 5
    after = {r.id: r.request_status for r in run.requests_after.collect()}
    assert len(after) == 13
    assert {i for i, status in after.items() if status == "PENDING"} == {5, 6, 13}
    assert run.licenses_after.count() == 11


def test_second_run_changes_nothing(tables):
    first = process_requests(tables, AS_OF, NOW)
    again = process_requests(
        Tables(tables.users, first.licenses_after, first.requests_after), AS_OF, NOW)
    assert again.new_licenses.isEmpty()
    assert values(again.requests_after) == values(first.requests_after)
    assert values(again.licenses_after) == values(first.licenses_after)


def test_licenses_of_an_interrupted_run_are_left_out(tables):
    first = process_requests(tables, AS_OF, NOW)
    restored = ops.not_issued_for_pending(first.licenses_after, tables.requests)
    assert values(restored) == values(tables.licenses)


def test_days_of_finished_runs_are_not_compared_with_waiting_requests(spark, monkeypatch):
    """A seat issued on 40 days by finished runs and asked for by 50 waiting requests."""
    days = [AS_OF - dt.timedelta(days=i + 1) for i in range(40)]
    at = [NOW - dt.timedelta(days=i + 1) for i in range(40)]
    seat = ("u", "Type 1", "P")
    settled = requests(spark, *((1000 + i, "u", "APPROVED", "Type 1", "P") for i in range(40))).withColumn(
        "processed_at", F.element_at(F.lit(at), (F.col("id") - 999).cast("int")))
    held = licenses(spark, *((f"old{i}", *seat, "EXPIRED", days[i]) for i in range(40))).withColumn(
        "_i", F.substring("license_id", 4, 2).cast("int") + 1).withColumns(
        {"start_date": F.element_at(F.lit(days), F.col("_i")),
         "created_at": F.element_at(F.lit(at), F.col("_i"))}).drop("_i")
    waiting = requests(spark, *((i, "u", "PENDING", "Type 1", "P") for i in range(50)))
    every = settled.unionByName(waiting)
    first = process_requests(Tables(users(spark, ("u", True)), held, every), AS_OF, NOW)
    assert first.new_licenses.count() == 50
    compared = []
    lacking = ops.lacking_match

    def watched(rows, others, on, unique=False):
        compared.append((on, others.count()))
        return lacking(rows, others, on, unique)

    monkeypatch.setattr(ops, "lacking_match", watched)
    restored = ops.not_issued_for_pending(first.licenses_after, every)
    assert values(restored) == values(held)
    # The 50 requests with the one day of the unfinished run, not with 41 days.
    assert compared == [(["created_at"], 40), (["license_id"], 50)]


def test_licenses_from_elsewhere_stay(spark):
    """Their times are no run's, so they are compared, and their ids are no request's."""
    tables = Tables(users(spark, ("u", True)),
                    licenses(spark, ("x", "u", "Type 1", "P", "ACTIVE", AFTER),
                             ("y", "u", "Type 1", "Q", "ACTIVE", AFTER)).withColumn(
                        "created_at", F.when(F.col("license_id") == "x", F.col("created_at"))),
                    requests(spark, (1, "u", "PENDING", "Type 1", "P"), (2, "u", "PENDING", "Type 1", "Q")))
    assert values(ops.not_issued_for_pending(tables.licenses, tables.requests)) == values(tables.licenses)


def test_empty_input(spark):
    run = process_requests(Tables(users(spark), licenses(spark), requests(spark)), AS_OF, NOW)
    assert run.decisions.isEmpty() and run.new_licenses.isEmpty()
    assert run.requests_after.isEmpty() and run.licenses_after.isEmpty()


def test_keys_of_different_types_are_refused(spark, tables):
    numbers = spark.range(3).withColumnRenamed("id", "userid")
    with pytest.raises(TypeError, match="userid"):
        mark_match(tables.requests, numbers, ["userid"], "known")
