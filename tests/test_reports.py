import itertools

import pytest
from rows import AFTER, AS_OF, BEFORE, ON, licenses, values

from seatwise.operators import reports as ops
from seatwise.plans.jobs import license_report

ROWS = [
    ("l1", "ann", "Type 2", "B", "ACTIVE", AFTER),
    ("l2", "ann", "Type 2", "B", "ACTIVE", ON),
    ("l3", "ann", "Type 1", "A", "ACTIVE", BEFORE),
    ("l4", "bob", "Type 2", "A", "ACTIVE", AFTER),
    ("l5", "bob", "Type 2", "A", "EXPIRED", AFTER),
    ("l6", "cat", "Type 1", "A", "EXPIRED", BEFORE),
    ("l7", "cat", "Type 3", "A", "SUSPENDED", AFTER),
    ("l8", "cat", "Type 3", "A", "active", AFTER),
]


@pytest.fixture(scope="module")
def seats(spark):
    return licenses(spark, *ROWS)


def tally(rows, key):
    """Counts by brute force."""
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row[1])
    return [(*k, len(set(users)), len(users)) for k, users in sorted(groups.items())]


def ordered(rows):
    return [tuple(r) for r in rows.collect()]


ACTIVE = [r for r in ROWS if r[4] == "ACTIVE" and r[5] >= AS_OF]
ACTIVE_EVER = [r for r in ROWS if r[4] == "ACTIVE"]


def shown(row):
    if row[4] != "ACTIVE":
        return row[4]
    return "Active" if row[5] >= AS_OF else "Expired"


def test_counts_by_type(seats):
    assert ordered(ops.counts_by_type(seats, AS_OF)) == tally(ACTIVE, lambda r: (r[2],))
    assert ordered(ops.counts_by_type(seats, AS_OF, True)) == tally(ACTIVE_EVER, lambda r: (r[2],))


def test_counts_by_type_and_product(seats):
    key = lambda r: (r[2], r[3])
    assert ordered(ops.counts_by_type_and_product(seats, AS_OF)) == tally(ACTIVE, key)
    assert ordered(ops.counts_by_type_and_product(seats, AS_OF, True)) == tally(ACTIVE_EVER, key)


def test_status_counts_are_sorted(seats):
    assert ordered(ops.counts_by_status(seats)) == tally(ROWS, lambda r: (r[4],))
    assert ordered(ops.expiry_breakdown(seats, AS_OF)) == tally(ROWS, lambda r: (r[2], shown(r)))


def test_distribution_ignores_the_date(seats):
    rows = ops.distribution(seats)
    assert rows.columns == ["license_type", "user_count", "total_licenses"]
    assert ordered(rows) == tally(ACTIVE_EVER, lambda r: (r[2],))


def test_totals(seats):
    assert ordered(ops.totals(seats, AS_OF)) == [(2, 3)]
    assert ordered(ops.totals(seats, AS_OF, True)) == [(2, 4)]


@pytest.mark.parametrize("include_expired", [False, True])
def test_one_pass_levels_agree_with_the_single_reports(seats, include_expired):
    rows = ops.counts_at_all_levels(seats, AS_OF, include_expired).collect()
    by_level = {
        level: sorted(tuple(v for v in (r.license_type, r.product_name) if v is not None)
                      + (r.unique_users, r.total_licenses) for r in group)
        for level, group in itertools.groupby(
            sorted(rows, key=lambda r: r.level), key=lambda r: r.level)
    }
    assert by_level == {
        "type": ordered(ops.counts_by_type(seats, AS_OF, include_expired)),
        "type_product": ordered(ops.counts_by_type_and_product(seats, AS_OF, include_expired)),
        "total": ordered(ops.totals(seats, AS_OF, include_expired)),
    }


def test_full_report_agrees_with_the_single_reports(seats):
    rows = values(ops.full_report(seats, AS_OF))
    wanted = (
        [("active_type", t, None, None, u, n) for t, u, n in ordered(ops.counts_by_type(seats, AS_OF))]
        + [("active_type_product", t, p, None, u, n)
           for t, p, u, n in ordered(ops.counts_by_type_and_product(seats, AS_OF))]
        + [("active_total", None, None, None, u, n) for u, n in ordered(ops.totals(seats, AS_OF))]
        + [("all_status", None, None, s, u, n) for s, u, n in ordered(ops.counts_by_status(seats))]
        + [("all_type_status", t, None, s, u, n)
           for t, s, u, n in ordered(ops.expiry_breakdown(seats, AS_OF))]
    )
    assert rows == sorted(wanted, key=repr)


def test_stored_report_splits_into_the_single_reports(seats):
    parts = ops.split_report(ops.full_report(seats, AS_OF))
    single = license_report(seats, AS_OF)
    assert parts.keys() == single.keys()
    for name, rows in parts.items():
        assert rows.columns == single[name].columns
        assert ordered(rows) == ordered(single[name])
    nothing = ops.split_report(ops.full_report(seats.limit(0), AS_OF))
    assert ordered(nothing["totals"]) == [(0, 0)]


def test_null_keys_are_groups_of_their_own(spark, seats):
    odd = seats.limit(1).selectExpr(
        "license_id", "userid", "CAST(NULL AS STRING) AS license_type", "start_date",
        "expiry_date", "product_name", "status", "created_at", "updated_at")
    rows = ops.counts_at_all_levels(odd, AS_OF, include_expired=True)
    assert values(rows, "license_type", "product_name", "level") == sorted(
        [(None, None, "type"), (None, "B", "type_product"), (None, None, "total")], key=repr)


def test_null_users_count_as_licenses_only(spark, seats):
    nobody = seats.selectExpr("license_id", "CAST(NULL AS STRING) AS userid", "license_type",
                              "expiry_date", "product_name", "status")
    assert ordered(ops.totals(nobody, AS_OF)) == [(0, 3)]


def test_empty_input(spark):
    empty = licenses(spark)
    assert ordered(ops.totals(empty, AS_OF)) == [(0, 0)]
    assert ops.counts_by_type(empty, AS_OF).isEmpty()


def test_report_bundle(seats):
    assert set(license_report(seats, AS_OF, detailed=False)) == {"by_type", "totals"}
    assert set(license_report(seats, AS_OF)) == {
        "by_type", "totals", "by_type_and_product", "by_status", "expiry_breakdown"}
    assert set(ops.detailed_summary(seats, AS_OF)) == {
        "active_by_type", "by_status", "expiry_breakdown"}
