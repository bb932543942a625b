"""Numbers 1..n in a given order, and running sums, without a single task for all rows.

Rows are dealt out by ranges of the order and sorted inside each range, and that form is
stored. A second pass adds to each row's place inside its range what the ranges before it
hold; there is one total per range, so only those go through one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of ``monotonically_increasing_id`` that count rows inside a partition.
_ROW_BITS = 33


def numbered(
    rows: DataFrame,
    order_by: Sequence[Column],
    store: Callable[[DataFrame, str], DataFrame],
    name: str = "number",
    sums: Mapping[str, str] | None = None,
    table: str | None = None,
) -> DataFrame:
    """``rows`` with their place in the order, from 1 without gaps, as column ``name``.

    ``sums`` maps new columns to columns whose sums over all earlier rows they get.
    ``store(rows, table)`` writes a table once and reads it back; places come from the
    stored files, so a retried task gives the same ones. The order should leave no ties:
    rows that tie are placed in any order, and all in one range.
    """
    sums = dict(sums or {})
    dealt = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id()
    kept = store(dealt.select(
        "*",
        F.shiftright(place, _ROW_BITS).alias("_range"),
        (place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1).alias("_place"),
    ), table or name)

    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = kept.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.sum(column).alias(new) for new, column in sums.items()))
    offsets = held.select("_range", *(
        F.coalesce(F.sum(column).over(before), F.lit(0)).alias(f"_before_{column}")
        for column in ("_rows", *sums)))

    # One row per range of the shuffle, however many rows there are.
    joined = kept.join(F.broadcast(offsets), "_range")
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, -1)
    return joined.select(
        *rows.columns,
        (F.col("_place") + F.col("_before__rows")).alias(name),
        *((F.coalesce(F.sum(column).over(inside), F.lit(0)) + F.col(f"_before_{new}")).alias(new)
          for new, column in sums.items()),
    )
