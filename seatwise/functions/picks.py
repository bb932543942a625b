"""Seeded pseudo-random picks that depend only on the row's key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, label: str, key: Column) -> Column:
    """32 hex digits; each pick below reads its own seven of them."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(label), key.cast("string")))


def number(hex_digits: Column, slot: int, size: int | Column) -> Column:
    """A whole number in [0, size) from slot 0..3 of a digest."""
    part = F.conv(F.substring(hex_digits, slot * 7 + 1, 7), 16, 10).cast("bigint")
    return part % (F.lit(size) if isinstance(size, int) else size)


def choice(hex_digits: Column, slot: int, values: Sequence) -> Column:
    """One of ``values``."""
    position = number(hex_digits, slot, len(values)).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), position + 1)
