"""Key look-ups that hold up when one key owns a large share of the rows.

Adaptive execution splits a skewed partition of ``rows`` over many tasks, but only
where both join inputs come straight from a shuffle. A looked-up table whose key is
declared unique is joined as it is. Any other is first reduced to its distinct keys,
with partial aggregation before the shuffle, so repeats neither multiply rows nor
pile up in one task. The partitioning left by that aggregate would serve the join
as well and thereby rule out splitting; a digest of the keys in the join condition
prevents that, at the price of shuffling the reduced key set once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST = "_key_digest"


def _check_types(rows: DataFrame, others: DataFrame, on: Sequence[str]) -> None:
    # Equal values of different types have different digests.
    for name in on:
        left, right = rows.schema[name].dataType, others.schema[name].dataType
        if left != right:
            raise TypeError(
                f"join key {name}: {left.simpleString()} and {right.simpleString()} differ"
            )


def _digest(on: Sequence[str]) -> Column:
    return F.xxhash64(*on).alias(DIGEST)


def _join_keys(
    rows: DataFrame, others: DataFrame, on: Sequence[str], unique: bool
) -> tuple[DataFrame, DataFrame, list[str]]:
    _check_types(rows, others, on)
    keys = others.select(*on)
    if unique:
        return rows, keys, list(on)
    return (
        rows.select("*", _digest(on)),
        keys.distinct().select("*", _digest(on)),
        [DIGEST, *on],
    )


def having_match(
    rows: DataFrame, others: DataFrame, on: Sequence[str], unique: bool = False
) -> DataFrame:
    """The rows whose key occurs in ``others``. A NULL key never matches.

    ``unique``: ``others`` holds each key once.
    """
    left, keys, by = _join_keys(rows, others, on, unique)
    return left.join(keys, by, "left_semi").select(*rows.columns)


def lacking_match(
    rows: DataFrame, others: DataFrame, on: Sequence[str], unique: bool = False
) -> DataFrame:
    """The rows whose key does not occur in ``others``; NULL keys stay."""
    left, keys, by = _join_keys(rows, others, on, unique)
    return left.join(keys, by, "left_anti").select(*rows.columns)


def mark_match(
    rows: DataFrame, others: DataFrame, on: Sequence[str], flag: str, unique: bool = False
) -> DataFrame:
    """``rows`` with a boolean column saying whether the key occurs in ``others``."""
    left, keys, by = _join_keys(rows, others, on, unique)
    joined = left.join(keys.select("*", F.lit(True).alias(flag)), by, "left")
    return joined.select(*rows.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def attach(rows: DataFrame, unique: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` left-joined with ``unique``, an aggregate with one row per key."""
    _check_types(rows, unique, on)
    extra = [name for name in unique.columns if name not in on]
    joined = rows.select("*", _digest(on)).join(
        unique.select("*", _digest(on)), [DIGEST, *on], "left")
    return joined.select(*rows.columns, *extra)
