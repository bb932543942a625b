"""Bitmaps of key hashes: most look-ups that find nothing are settled before a shuffle.

A filter is a Bloom filter with one hash: a bit per hash value, kept in bitmaps of
``BLOCK_BITS`` bits, one row each. A key whose bit is not set does not occur; one whose
bit is set may, and takes the exact join. The bitmaps are the only thing broadcast, and
their size is fixed before they are built: beyond ``MOST_BYTES`` there is no filter, and
every row takes the exact join.

The probe is a join with the bitmaps on the number of the block. It neither shuffles nor
groups rows, so a key that owns a third of them is spread as the files are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap of ``bitmap_construct_agg``.
BLOCK_BITS = 32_768
#: Bits a key: about one key in 17 that does not occur hits a set bit.
BITS_PER_KEY = 16
MOST_BYTES = 64 << 20

Store = Callable[[DataFrame, str], DataFrame]


def _position(on: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(bits))


@dataclass(frozen=True)
class KeyFilter:
    """Which values of the columns ``on`` may occur; ``bits`` is a multiple of a block."""

    bitmaps: DataFrame
    bits: int
    on: tuple[str, ...]

    def mark(self, rows: DataFrame, flag: str) -> DataFrame:
        """``rows`` with a boolean column that is false where the key cannot occur.

        A NULL in the key never occurs. No row is dropped or repeated.
        """
        at = _position(self.on, self.bits)
        there = F.lit(True)
        for name in self.on:
            there = there & F.col(name).isNotNull()
        placed = rows.select("*", F.when(there, at).alias("_filter_at"))
        joined = placed.join(
            F.broadcast(self.bitmaps),
            F.col("_filter_at").bitwiseAND(F.lit(-BLOCK_BITS)) == F.col("_filter_block"), "left")
        inside = F.col("_filter_at").bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
        byte = F.get("_filter_bits", F.shiftright(inside, 3)).cast("int") + 128
        bit = F.expr("shiftright(_filter_byte, cast(_filter_at & 7 as int)) & 1")
        return joined.select(*rows.columns, "_filter_at", byte.alias("_filter_byte")).select(
            *rows.columns, F.coalesce(bit == 1, F.lit(False)).alias(flag))


def key_filter(
    keys: DataFrame, on: Sequence[str], store: Store, name: str = "key_filter",
    bits_per_key: int = BITS_PER_KEY, most_bytes: int = MOST_BYTES,
) -> KeyFilter | None:
    """A filter for the values of ``on`` in ``keys``; None if it would exceed ``most_bytes``.

    The size comes from a count of the rows, which repeats only make too large. ``store``
    keeps the bitmaps, so that they are built once.
    """
    rows = keys.select(*on).dropna()
    blocks = max(1, -(-rows.count() * bits_per_key // BLOCK_BITS))
    bits = 1 << (blocks * BLOCK_BITS - 1).bit_length()
    if bits // 8 > most_bytes:
        return None
    placed = rows.select(_position(on, bits).alias("_filter_at"))
    bitmaps = placed.groupBy(
        F.col("_filter_at").bitwiseAND(F.lit(-BLOCK_BITS)).alias("_filter_block")
    ).agg(F.bitmap_construct_agg(
        F.col("_filter_at").bitwiseAND(F.lit(BLOCK_BITS - 1))).alias("_filter_bits"))
    # As an array of bytes, less 128, from which a probe takes one in constant time.
    each = F.expr(f"""transform(sequence(1, {BLOCK_BITS // 8}), i ->
        cast(cast(conv(hex(substring(_filter_bits, i, 1)), 16, 10) as int) - 128 as tinyint))""")
    bitmaps = bitmaps.select("_filter_block", each.alias("_filter_bits"))
    return KeyFilter(store(bitmaps, name), bits, tuple(on))


def may_occur(rows: DataFrame, known: KeyFilter | None) -> DataFrame:
    """The rows whose key may occur, all of them without a filter."""
    if known is None:
        return rows
    return known.mark(rows, "_may").filter("_may").drop("_may")


def cannot_occur(rows: DataFrame, known: KeyFilter | None) -> DataFrame:
    """The rows that ``may_occur`` leaves out."""
    if known is None:
        return rows.limit(0)
    return known.mark(rows, "_may").filter("NOT _may").drop("_may")
