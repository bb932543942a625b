"""Filters of key hashes: no key is lost, and few rows that match nothing are shuffled."""

import pytest
from pyspark.sql import functions as F
from test_skew import AS_OF, settings, shuffled_rows, skewed_joins, small_partitions  # noqa: F401

from seatwise.operators import key_filter as filters
from seatwise.operators import requests
from seatwise.session import table_store

ROWS = 60_000


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return table_store(spark, str(tmp_path_factory.mktemp("filters")))


def wanting(spark, rows=ROWS, known=1000):
    """Pending requests, a third of them of user 0 and nine tenths of the others of unknown users."""
    n = F.col("id")
    user = F.when(n % 3 == 0, F.lit(0)).otherwise(n % (10 * known))
    return spark.range(0, rows, numPartitions=12).select(
        "id", user.cast("string").alias("userid"), F.lit("PENDING").alias("request_status"),
        F.concat(F.lit("Type "), (n % 7).cast("string")).alias("license_type"),
        F.when(n % 11 > 0, "A").alias("product_name"),
        F.lit(None).cast("timestamp_ntz").alias("requested_at"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"))


def tables(spark, known=1000):
    users = spark.range(1, known, numPartitions=4).select(F.col("id").cast("string").alias("userid"))
    licenses = spark.range(0, known, numPartitions=4).select(
        F.col("id").cast("string").alias("license_id"), F.col("id").cast("string").alias("userid"),
        F.lit("Type 1").alias("license_type"), F.lit("2025-01-01").cast("date").alias("start_date"),
        F.lit("2025-12-31").cast("date").alias("expiry_date"), F.lit("A").alias("product_name"),
        F.lit("ACTIVE").alias("status"))
    return users, licenses


def test_every_key_may_occur_and_few_others(spark, store):
    keys = spark.range(20_000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("t"))
    known = filters.key_filter(keys, ["k", "t"], store, "some")
    probes = spark.range(60_000).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    marked = known.mark(probes, "may")
    assert marked.count() == 60_000
    assert marked.filter("k % 3 = 0 AND NOT may").isEmpty()
    # one hash: a share of at most keys / bits of the others
    assert marked.filter("k % 3 <> 0 AND may").count() < 40_000 * 1.2 / filters.BITS_PER_KEY
    both = filters.may_occur(probes, known).unionByName(filters.cannot_occur(probes, known))
    assert sorted(both.collect()) == sorted(probes.collect())


def test_nulls_and_empty_tables(spark, store):
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    probes = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), ("b", 4)], "k string, _block int")
    known = filters.key_filter(keys, ["k"], store, "nulls")
    found = filters.may_occur(probes, known)
    assert {r[1] for r in found.collect()} >= {1, 3} and 2 not in {r[1] for r in found.collect()}
    none = filters.key_filter(keys.limit(0), ["k"], store, "none")
    assert filters.may_occur(probes, none).isEmpty()
    assert filters.cannot_occur(probes, none).count() == 4
    assert filters.may_occur(probes.limit(0), known).isEmpty()


def test_too_many_keys_give_no_filter(spark, store):
    keys = spark.range(10_000).select(F.col("id").alias("k"))
    assert filters.key_filter(keys, ["k"], store, "large", most_bytes=4096) is None
    assert filters.may_occur(keys, None).count() == 10_000
    assert filters.cannot_occur(keys, None).isEmpty()


def filled(spark, store, name):
    users, licenses = tables(spark)
    known, held = requests.request_filters(users, licenses, lambda r, n: store(r, f"{name}-{n}"), AS_OF)
    return wanting(spark), users, licenses, known, held


@pytest.mark.parametrize("without", ["none", "users", "seats", "both"])
def test_same_decisions(spark, store, without):
    pending, users, licenses, known, held = filled(spark, store, f"same-{without}")
    if without in ("users", "both"):
        known = None
    if without in ("seats", "both"):
        held = None
    found = requests.decide_filtered(pending, users, licenses, known, held, AS_OF)
    wanted = requests.decide(pending, users, licenses, AS_OF)
    assert found.columns == wanted.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    valid = requests.valid_requests_filtered(pending, users, known)
    assert sorted(map(repr, valid.collect())) == sorted(
        map(repr, requests.valid_requests(pending, users).collect()))


def test_few_rows_are_shuffled(spark, store, small_partitions):  # noqa: F811
    pending, users, licenses, known, held = filled(spark, store, "few")
    plain = sum(shuffled_rows(requests.decide(pending, users, licenses, AS_OF)))
    filtered = sum(shuffled_rows(
        requests.decide_filtered(pending, users, licenses, known, held, AS_OF)))
    assert filtered < plain * 0.25
    every = sum(shuffled_rows(requests.valid_requests(pending, users)))
    assert sum(shuffled_rows(requests.valid_requests_filtered(pending, users, known))) < every * 0.25


def test_a_hot_user_that_occurs_is_still_split(spark, store, small_partitions):  # noqa: F811
    pending, users, licenses, _, _ = filled(spark, store, "hot0")
    users = users.unionByName(spark.createDataFrame([("0",)], "userid string"))
    known, held = requests.request_filters(users, licenses, lambda r, n: store(r, f"hot-{n}"), AS_OF)
    decided = requests.decide_filtered(pending, users, licenses, known, held, AS_OF)
    assert skewed_joins(decided) >= 1
    valid = requests.valid_requests_filtered(pending, users, known)
    assert skewed_joins(valid) == 1
