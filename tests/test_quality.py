import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import AFTER, OLD, licenses, requests, users, values

from seatwise.operators import quality as ops
from seatwise.schemas import LICENSES


def counts(rows, rules):
    return {r.rule: r.violations for r in ops.rule_counts(rows, rules, "t").collect()}


@pytest.mark.parametrize("email, accepted", [
    ("a@b.co", True), ("A.b+c%d@x-y.ORG", True), ("a@b.co and more", True), ("a@b.c0m", False),
    ("a@b.c", False), ("bad at x", False), (" a@b.co", False), ("a@b", False), ("", False),
])
def test_email_pattern(spark, email, accepted):
    rows = spark.createDataFrame([(email,)], ["email"])
    assert ops.broken_rows(rows, [ops.email_rule()]).isEmpty() is accepted


def test_null_passes_checks_but_not_null_rules(spark):
    rows = requests(spark, (1, "u", "PENDING", None, None), (2, "u", "pending", "type 1", "A"))
    assert counts(rows, ops.rules_for("requests")) == {
        "id is null": 0, "userid is null": 0, "request_status is null": 0,
        "license_type outside domain": 1, "request_status outside domain": 1,
        "userid longer than 50": 0, "request_status longer than 20": 0,
        "license_type longer than 20": 0, "product_name longer than 100": 0}


def test_license_rules_find_each_broken_row(spark):
    day = dt.date(2025, 1, 1)
    good = ("l1", "u", "Type 1", day, AFTER, "A", "ACTIVE", OLD, OLD)
    bad = [
        ("l2", "u", "Type 1", day, day, "A", "ACTIVE", OLD, OLD),
        ("l3", "u", "Type 4", day, AFTER, "A", "GONE", OLD, OLD),
        ("l4", "u" * 51, "Type 1", day, AFTER, "p" * 101, "ACTIVE", OLD, OLD),
    ]
    rows = spark.createDataFrame([good, *bad], LICENSES)
    found = ops.broken_rows(rows, ops.rules_for("licenses"))
    assert values(found, "license_id", "rule") == [
        ("l2", "expiry_date not after start_date"),
        ("l3", "license_type outside domain"), ("l3", "status outside domain"),
        ("l4", "product_name longer than 100"), ("l4", "userid longer than 50")]


def test_not_null_rules(spark):
    rows = users(spark, ("a", True)).withColumn("email", F.lit(None).cast("string"))
    assert counts(rows, ops.not_null_rules("users")) == {
        "userid is null": 0, "name is null": 0, "email is null": 1}


def test_empty_table_counts_zero(spark):
    assert set(counts(licenses(spark), ops.rules_for("licenses")).values()) == {0}


def test_rules_of_a_table_need_one_scan(spark, tmp_path):
    licenses(spark, ("l1", "u", "Type 1", "A", "ACTIVE", AFTER)).write.parquet(str(tmp_path / "l"))
    rows = ops.rule_counts(spark.read.parquet(str(tmp_path / "l")), ops.rules_for("licenses"), "l")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_repeated_and_missing_keys(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert values(ops.repeated_keys(rows, "k")) == [("a", 2)]
    assert values(ops.key_counts(rows, "k", "t")) == [("t", 1, 2)]
    assert values(ops.key_counts(rows.limit(0), "k", "t")) == [("t", 0, 0)]


def test_orphans(spark):
    rows = licenses(
        spark, ("l1", "a", "Type 1", "A", "ACTIVE", AFTER), ("l2", "A", "Type 1", "A", "ACTIVE", AFTER))
    assert values(ops.orphan_licenses(rows, users(spark, ("a", True))), "license_id") == [("l2",)]
