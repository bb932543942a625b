"""The reference date and time of a run, as foldable columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Day = dt.date | str | None
Moment = dt.datetime | str | None


def day(as_of: Day = None) -> Column:
    """``as_of`` as a date; the session's current date if none is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def moment(now: Moment = None) -> Column:
    """``now`` as a timestamp without time zone; the session's clock if none is given."""
    if now is None:
        return F.localtimestamp()
    return F.lit(str(now)).cast("timestamp_ntz")


def pinned(spark: SparkSession, as_of: Day, now: Moment) -> tuple[str, str]:
    """Both as text, read off the session's clock where not given.

    A job that writes several tables pins them first, so all its rows agree.
    """
    row = spark.range(1).select(
        day(as_of).cast("string").alias("day"), moment(now).cast("string").alias("moment")
    ).first()
    return row["day"], row["moment"]
