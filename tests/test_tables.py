import pytest
from pyspark.sql import functions as F
from rows import NOW, OLD, users, values

from seatwise.operators import tables as ops


def test_insert_or_ignore_keeps_existing_and_first_rows(spark):
    target = users(spark, ("a", True), ("b", False))
    new = target.limit(0).withColumn("place", F.lit(0))
    for user, flag, place in (("a", False, 1), ("c", False, 3), ("c", True, 2), ("d", None, 1)):
        new = new.unionByName(users(spark, (user, flag)).withColumn("place", F.lit(place)))
    result = ops.insert_or_ignore(target, new, "userid", ["place"])
    assert result.columns == target.columns
    assert values(result, "userid", "islicenseactive") == [
        ("a", True), ("b", False), ("c", True), ("d", None)]
    again = ops.insert_or_ignore(result, new, "userid", ["place"])
    assert values(again) == values(result)


def test_ranking_and_look_up_share_one_shuffle_of_the_incoming_rows(spark, tmp_path):
    for name in ("target", "incoming"):
        users(spark, ("a", True)).write.parquet(str(tmp_path / name))
    target, new = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "incoming"))
    result = ops.insert_or_ignore(target, new.hint("merge"), "userid", ["created_at"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "WindowGroupLimit" in plan


def test_insert_of_a_null_key_fails(spark):
    target = users(spark, ("a", True))
    new = target.withColumn("userid", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="insert with NULL userid"):
        ops.insert_or_ignore(target, new, "userid", ["name"]).collect()
    assert ops.insert_or_ignore(new, target, "userid", ["name"]).count() == 2


def test_defaults_fill_nulls_and_absent_columns(spark):
    bare = spark.createDataFrame(
        [(1, "u", None, "Type 1"), (2, "v", "FAILED", None)],
        "id long, userid string, request_status string, license_type string")
    filled = ops.fill_defaults(bare, "requests", NOW).orderBy("id").collect()
    assert [r.request_status for r in filled] == ["PENDING", "FAILED"]
    assert [r.license_type for r in filled] == ["Type 1", None]
    assert {r.requested_at for r in filled} == {NOW}
    assert {r.processed_at for r in filled} == {None}


def test_user_and_license_defaults(spark):
    bare = spark.createDataFrame([("u", "N", "e@x.org", OLD)],
                                 "userid string, name string, email string, created_at timestamp_ntz")
    row = ops.fill_defaults(bare, "users", NOW).first()
    assert (row.islicenseactive, row.created_at, row.updated_at) == (False, OLD, NOW)
    bare = spark.createDataFrame([("u",), ("v",)], "userid string")
    rows = ops.fill_defaults(bare, "licenses", NOW).collect()
    assert {r.status for r in rows} == {"ACTIVE"}
    assert len({r.license_id for r in rows}) == 2
