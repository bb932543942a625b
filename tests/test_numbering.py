"""Dense numbers and running sums by ranges."""

import itertools

import pytest
from pyspark.sql import functions as F

from seatwise.operators.numbering import numbered
from seatwise.session import table_store


def places(frame):
    return [tuple(r) for r in frame.orderBy("n").collect()]


@pytest.mark.parametrize("count", [0, 1, 7, 20_000])
def test_numbers_are_dense_and_in_order(spark, count):
    rows = spark.range(count).select(
        (F.col("id") * 7919 % 20_011).alias("key"), (F.col("id") % 5).alias("size")).repartition(6)
    found = places(numbered(
        rows, [F.col("key").desc()], table_store(spark), "n", {"earlier": "size"}))
    wanted = sorted(((i * 7919 % 20_011, i % 5) for i in range(count)), reverse=True)
    sums = [0, *itertools.accumulate(size for _, size in wanted)]
    assert found == [(key, size, i + 1, sums[i]) for i, (key, size) in enumerate(wanted)]


def test_a_hot_part_is_dealt_over_many_ranges(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("kind"), "id")
    seen = {}

    def keep(frame, name):
        seen["table"] = table_store(spark)(frame, name)
        return seen["table"]

    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        found = numbered(rows, [F.col("kind"), F.col("id")], keep, "n")
        assert found.agg(F.countDistinct("n"), F.min("n"), F.max("n")).first()[:] == (30_000, 1, 30_000)
    finally:
        spark.conf.unset(merge)
    hot = seen["table"].filter("kind = 'hot'").groupBy("_range").count().collect()
    assert len(hot) >= 2 and max(r["count"] for r in hot) < 10_000


def test_nulls_and_names(spark):
    rows = spark.createDataFrame([(None, 1), ("b", 2), (None, 3), ("a", 4)], "k string, number int")
    found = numbered(rows, [F.col("k").asc_nulls_last(), F.col("number")], table_store(spark), "n")
    assert [tuple(r) for r in found.orderBy("n").collect()] == [
        ("a", 4, 1), ("b", 2, 2), (None, 1, 3), (None, 3, 4)]
