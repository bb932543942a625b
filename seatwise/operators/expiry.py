"""Expiring licenses and keeping each user's flag in step with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatwise.functions.clock import Day, Moment, moment
from seatwise.functions.licenses import is_active, is_due
from seatwise.operators.matching import attach, lacking_match


def licenses_to_expire(licenses: DataFrame, as_of: Day = None) -> DataFrame:
    return licenses.filter(is_due(as_of)).select("license_id")


def expire_licenses(licenses: DataFrame, as_of: Day = None, now: Moment = None) -> DataFrame:
    """The license table with due rows EXPIRED and stamped; a projection, no shuffle."""
    due = is_due(as_of)
    return licenses.select(*(
        F.when(due, F.lit("EXPIRED")).otherwise(F.col("status")).alias("status")
        if name == "status"
        else F.when(due, moment(now)).otherwise(F.col("updated_at")).alias("updated_at")
        if name == "updated_at"
        else F.col(name)
        for name in licenses.columns
    ))


def expired_changes(licenses: DataFrame, as_of: Day = None, now: Moment = None) -> DataFrame:
    """Only the rows the run changes, with their new status and stamp."""
    return licenses.filter(is_due(as_of)).select(
        "license_id", F.lit("EXPIRED").alias("status"), moment(now).alias("updated_at")
    )


def user_licenses(users: DataFrame, licenses: DataFrame) -> DataFrame:
    """All users with their licenses, one row per license, or one with NULLs.

    License columns named like a user column get the prefix ``license_``. Written as
    matched rows plus users without any: a left join from users would put the
    licenses on the side adaptive execution cannot split.
    """
    held = licenses.select(F.col("userid").alias("_holder"), *(
        F.col(name).alias(f"license_{name}" if name in users.columns else name)
        for name in licenses.columns if name != "userid"
    ))
    extra = [field for field in held.schema if field.name != "_holder"]
    matched = held.join(users, F.col("_holder") == F.col("userid"), "inner").select(
        *users.columns, *(field.name for field in extra)
    )
    holders = licenses.select("userid").distinct()
    empty = lacking_match(users, holders, ["userid"], unique=True).select(
        "*", *(F.lit(None).cast(field.dataType).alias(field.name) for field in extra)
    )
    return matched.unionByName(empty)


def license_counts(users: DataFrame, licenses: DataFrame) -> DataFrame:
    """Every user with the number of licenses held, zero included."""
    held = licenses.groupBy("userid").agg(F.count(F.lit(1)).alias("licenses"))
    return users.select("userid").join(held, "userid", "left").select(
        "userid", F.coalesce("licenses", F.lit(0)).alias("licenses")
    )


def active_license_counts(licenses: DataFrame, as_of: Day = None) -> DataFrame:
    """Licenses per user and how many of them are active now."""
    return licenses.groupBy("userid").agg(
        F.count_if(is_active(as_of)).alias("active_licenses"),
        F.count(F.lit(1)).alias("licenses"),
    )


def _holders(licenses: DataFrame, as_of: Day, inclusive: bool) -> DataFrame:
    return (
        licenses.filter(is_active(as_of, inclusive)).select("userid").distinct()
        .withColumn("_active", F.lit(True))
    )


def _with_target_flag(
    users: DataFrame, licenses: DataFrame, as_of: Day, inclusive: bool
) -> DataFrame:
    # Users hold one row per key, so the plain join on the aggregate's own
    # partitioning cannot skew.
    joined = users.join(_holders(licenses, as_of, inclusive), "userid", "left")
    return joined.select(
        *users.columns, F.coalesce("_active", F.lit(False)).alias("should_be_active")
    )


def _drifted(null_safe: bool) -> Column:
    stored, target = F.col("islicenseactive"), F.col("should_be_active")
    return ~stored.eqNullSafe(target) if null_safe else stored != target


def flag_drift(
    users: DataFrame,
    licenses: DataFrame,
    as_of: Day = None,
    inclusive: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Users whose stored flag disagrees with their licenses.

    A NULL flag compares as unknown, so such users are listed only if ``null_safe``.
    """
    return (
        _with_target_flag(users.select("userid", "islicenseactive"), licenses, as_of, inclusive)
        .filter(_drifted(null_safe))
        .select("userid", "should_be_active")
    )


def refresh_flags(
    users: DataFrame,
    licenses: DataFrame,
    as_of: Day = None,
    now: Moment = None,
    inclusive: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """The user table with drifted flags corrected; only changed rows are stamped."""
    target = _with_target_flag(users, licenses, as_of, inclusive)
    return _set_flags(target, users.columns, _drifted(null_safe), now)


def apply_flag_changes(users: DataFrame, changes: DataFrame, now: Moment = None) -> DataFrame:
    """``users`` with the flags that ``flag_drift`` found, kept as a table."""
    target = users.join(changes, "userid", "left")
    return _set_flags(target, users.columns, F.col("should_be_active").isNotNull(), now)


def flags_from_licenses(
    users: DataFrame, licenses: DataFrame, as_of: Day = None, inclusive: bool = False
) -> DataFrame:
    """Every user's flag computed afresh: does the user hold an active license."""
    target = _with_target_flag(users.select("userid"), licenses, as_of, inclusive)
    return target.withColumnRenamed("should_be_active", "islicenseactive")


def refresh_touched(
    users: DataFrame,
    licenses: DataFrame,
    touched: DataFrame,
    as_of: Day = None,
    now: Moment = None,
    inclusive: bool = False,
) -> DataFrame:
    """Recompute the flag of users whose licenses were inserted, changed or moved.

    ``touched`` lists their ids, old and new owner both, repeats allowed. Every
    touched row is stamped, also when its flag keeps its value.
    """
    target = _with_target_flag(users, licenses, as_of, inclusive)
    marks = touched.select("userid").distinct().withColumn("_touched", F.lit(True))
    target = target.join(marks, "userid", "left")
    return _set_flags(target, users.columns, F.col("_touched"), now)


def _set_flags(target: DataFrame, columns: list[str], changed: Column, now: Moment) -> DataFrame:
    return target.select(*(
        F.when(changed, F.col("should_be_active")).otherwise(F.col(name)).alias(name)
        if name == "islicenseactive"
        else F.when(changed, moment(now)).otherwise(F.col(name)).alias(name)
        if name == "updated_at"
        else F.col(name)
        for name in columns
    ))


def remove_users(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Users or licenses left after the users in ``removed`` are deleted."""
    return lacking_match(rows, removed, ["userid"])


def rename_users(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Users or licenses after changing user ids by ``renames(userid, new_userid)``.

    Two different new ids for one user, and a new id that is NULL, fail the job. For the
    user table, whose ids are unique, use ``rename_unique_users``.
    """
    target = renames.groupBy("userid").agg(
        F.when(F.count("new_userid") < F.count(F.lit(1)),
               F.raise_error(F.lit("a user is renamed to NULL")))
        .when(F.min("new_userid") == F.max("new_userid"), F.max("new_userid"))
        .otherwise(F.raise_error(F.lit("one user is renamed to two ids")))
        .alias("_new_userid")
    )
    moved = attach(rows, target, ["userid"])
    return moved.select(*(
        F.coalesce("_new_userid", "userid").alias("userid") if name == "userid" else F.col(name)
        for name in rows.columns
    ))


def rename_unique_users(users: DataFrame, renames: DataFrame) -> DataFrame:
    """The user table after ``rename_users``; two users of one id fail the job."""
    moved = rename_users(users, renames)
    place = F.row_number().over(Window.partitionBy("userid").orderBy(F.lit(1)))
    first = F.when(place == 1, F.col("userid")).otherwise(
        F.raise_error(F.lit("two users would have one id")).cast(moved.schema["userid"].dataType))
    return moved.select(*(first.alias(c) if c == "userid" else F.col(c) for c in moved.columns))
