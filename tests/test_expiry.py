import pytest
from rows import AFTER, AS_OF, BEFORE, NOW, OLD, ON, licenses, users, values

from seatwise.operators import expiry as ops
from seatwise.plans.jobs import expire_and_refresh


@pytest.fixture(scope="module")
def people(spark):
    return users(
        spark, ("on", False), ("before", True), ("after", False), ("none", True),
        ("unset", None), ("right", True), ("lower", True), ("idle", False))


@pytest.fixture(scope="module")
def seats(spark):
    return licenses(
        spark,
        ("l1", "on", "Type 1", "A", "ACTIVE", ON),
        ("l2", "before", "Type 1", "A", "ACTIVE", BEFORE),
        ("l3", "before", "Type 1", "A", "SUSPENDED", AFTER),
        ("l4", "after", "Type 1", "A", "ACTIVE", AFTER),
        ("l5", "after", "Type 1", "A", "ACTIVE", AFTER),
        ("l6", "unset", "Type 1", "A", "ACTIVE", AFTER),
        ("l7", "right", "Type 1", "A", "ACTIVE", AFTER),
        ("l8", "right", "Type 1", "A", "ACTIVE", BEFORE),
        ("l9", "lower", "Type 1", "A", "active", AFTER),
        ("l10", "stranger", "Type 1", "A", "ACTIVE", BEFORE),
    )


def test_due_licenses(seats):
    assert values(ops.licenses_to_expire(seats, AS_OF)) == [("l10",), ("l2",), ("l8",)]


def test_expiring_stamps_only_due_rows(seats):
    after = {r.license_id: r for r in ops.expire_licenses(seats, AS_OF, NOW).collect()}
    assert len(after) == 10
    due = {i for i, r in after.items() if r.updated_at == NOW}
    assert due == {"l2", "l8", "l10"}
    assert all(after[i].status == "EXPIRED" for i in due)
    assert after["l1"].status == "ACTIVE" and after["l1"].updated_at == OLD
    changes = ops.expired_changes(seats, AS_OF, NOW)
    assert values(changes) == [(i, "EXPIRED", NOW) for i in ("l10", "l2", "l8")]


def test_drift_skips_unset_flags(people, seats):
    assert values(ops.flag_drift(people, seats, AS_OF)) == [
        ("after", True), ("before", False), ("lower", False), ("none", False), ("on", True)]


def test_unset_flags_drift_when_asked_for(people, seats):
    listed = values(ops.flag_drift(people, seats, AS_OF, null_safe=True))
    assert ("unset", True) in listed and len(listed) == 6
    after = ops.refresh_flags(people, seats, AS_OF, NOW, null_safe=True)
    assert after.filter("islicenseactive IS NULL").isEmpty()


def test_the_expiry_day_counts_only_when_inclusive(people, seats):
    strict = ops.flag_drift(people, seats, AS_OF, inclusive=False)
    assert ("on", True) not in values(strict)


def test_refresh_stamps_only_changed_rows(people, seats):
    after = {r.userid: r for r in ops.refresh_flags(people, seats, AS_OF, NOW).collect()}
    assert len(after) == 8
    changed = {u for u, r in after.items() if r.updated_at == NOW}
    assert changed == {"after", "before", "lower", "none", "on"}
    assert after["unset"].islicenseactive is None
    assert after["right"].islicenseactive is True
    assert ops.flag_drift(ops.refresh_flags(people, seats, AS_OF), seats, AS_OF).isEmpty()


def test_flags_from_licenses_cover_everyone(people, seats):
    assert dict(values(ops.flags_from_licenses(people, seats, AS_OF))) == {
        "on": False, "before": False, "after": True, "none": False, "unset": True,
        "right": True, "lower": False, "idle": False}
    inclusive = dict(values(ops.flags_from_licenses(people, seats, AS_OF, inclusive=True)))
    assert inclusive["on"] is True


def test_touched_users_are_recomputed_and_stamped(spark, people, seats):
    touched = spark.createDataFrame([("unset",), ("none",), ("right",), ("right",)], ["userid"])
    rows = ops.refresh_touched(people, seats, touched, AS_OF, NOW).collect()
    after = {r.userid: r for r in rows}
    assert len(rows) == 8
    assert {u for u, r in after.items() if r.updated_at == NOW} == {"unset", "none", "right"}
    assert after["unset"].islicenseactive is True
    assert after["none"].islicenseactive is False
    assert after["before"].islicenseactive is True


def test_user_licenses_keep_users_without_any(people, seats):
    rows = values(ops.user_licenses(
        people.select("userid"), seats.select("userid", "license_id")))
    assert rows == sorted([
        ("on", "l1"), ("before", "l2"), ("before", "l3"), ("after", "l4"), ("after", "l5"),
        ("unset", "l6"), ("right", "l7"), ("right", "l8"), ("lower", "l9"),
        ("none", None), ("idle", None)], key=repr)


def test_user_licenses_of_whole_tables(people, seats):
    rows = ops.user_licenses(people, seats)
    assert rows.columns == [
        *people.columns, "license_id", "license_type", "start_date", "expiry_date",
        "product_name", "status", "license_created_at", "license_updated_at"]
    assert rows.count() == 11


def test_license_counts(people, seats):
    assert dict(values(ops.license_counts(people, seats))) == {
        "on": 1, "before": 2, "after": 2, "none": 0, "unset": 1, "right": 2, "lower": 1,
        "idle": 0}
    active = {u: n for u, n, _ in values(ops.active_license_counts(seats, AS_OF))}
    assert active == {"on": 1, "before": 0, "after": 2, "unset": 1, "right": 1, "lower": 0,
                      "stranger": 0}


def test_removing_users_takes_their_licenses(spark, people, seats):
    removed = spark.createDataFrame([("after",), ("after",), ("ghost",)], ["userid"])
    assert ops.remove_users(people, removed).count() == 7
    assert values(ops.remove_users(seats, removed), "license_id") == sorted(
        [(f"l{i}",) for i in (1, 2, 3, 6, 7, 8, 9, 10)], key=repr)


def test_renaming_users_renames_their_licenses(spark, people, seats):
    renames = spark.createDataFrame(
        [("after", "later"), ("after", "later")], "userid string, new_userid string")
    assert "later" in {r.userid for r in ops.rename_users(people, renames).collect()}
    renamed = ops.rename_users(seats, renames)
    assert renamed.count() == 10
    assert renamed.filter("userid = 'later'").count() == 2


def test_renaming_to_two_ids_fails(spark, seats):
    renames = spark.createDataFrame(
        [("after", "x"), ("after", "y")], "userid string, new_userid string")
    with pytest.raises(Exception, match="renamed to two ids"):
        ops.rename_users(seats, renames).collect()


def test_job(people, seats):
    run = expire_and_refresh(people, seats, AS_OF, NOW)
    assert run.counts() == {"licenses_expired": 3, "users_updated": 5}
    assert ops.licenses_to_expire(run.licenses_after, AS_OF).isEmpty()
    again = expire_and_refresh(run.users_after, run.licenses_after, AS_OF, NOW)
    assert again.counts() == {"licenses_expired": 0, "users_updated": 0}
    assert values(again.users_after) == values(run.users_after)
    assert values(again.licenses_after) == values(run.licenses_after)


def test_empty_input(spark):
    run = expire_and_refresh(users(spark), licenses(spark), AS_OF, NOW)
    assert run.counts() == {"licenses_expired": 0, "users_updated": 0}
    assert run.users_after.isEmpty()
