"""Column defaults and insert-or-ignore."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatwise.functions.clock import Moment, moment
from seatwise.functions.licenses import license_id_for
from seatwise.operators.matching import lacking_match
from seatwise.schemas import BY_NAME


def fill_defaults(rows: DataFrame, table: str, now: Moment = None) -> DataFrame:
    """``rows`` with the table's declared defaults in place of NULLs or absent columns.

    A license without an id gets one derived from its other columns, so that it is the
    same on every read; equal rows get equal ids.
    """
    # The declared column defaults.
    defaults = {
        "requests": {"request_status": F.lit("PENDING"), "requested_at": moment(now)},
        "users": {
            "islicenseactive": F.lit(False),
            "created_at": moment(now),
            "updated_at": moment(now),
        },
        "licenses": {
            "license_id": license_id_for(*(
                F.col(f.name) for f in BY_NAME["licenses"]
                if f.name != "license_id" and f.name in rows.columns
            )),
            "status": F.lit("ACTIVE"),
            "created_at": moment(now),
            "updated_at": moment(now),
        },
    }[table]
    columns = []
    for field in BY_NAME[table]:
        present = field.name in rows.columns
        value = F.col(field.name) if present else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name]) if present else defaults[field.name]
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def insert_or_ignore(
    target: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """``target`` plus the incoming rows whose key it lacks, one row per key.

    Of several incoming rows with one key the first by ``order_by`` is kept. Spark
    applies that limit inside each task before the shuffle too, so a key that fills
    a third of ``incoming`` sends one row per task. A NULL key fails the job.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    # Comparing the rank, rather than changing the key, leaves the partitioning of the
    # ranking to the join below and keeps the check off the target's keys.
    first_place = F.when(
        F.col(key).isNull(), F.raise_error(F.lit(f"insert with NULL {key}")).cast("int")
    ).otherwise(F.lit(1))
    first = (
        incoming.withColumn("_rank", rank)
        .filter((F.col("_rank") <= 1) & (F.col("_rank") >= first_place))
        .select(*target.columns)
    )
    return target.unionByName(lacking_match(first, target, [key], unique=True))
