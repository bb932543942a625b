"""Reading tables, intermediate tables and small numpy kernels shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.session import table_store

#: Bytes of text handled by one numpy pass. Longer single texts make longer passes.
PART_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the path of the driver's copy.

    Where a cluster does not share that path, the package has to be installed.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, found)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def store(spark: SparkSession):
    """Write a DataFrame once in the shared folder and read it back."""
    importable(spark)
    return table_store(spark)


def held_back(id_column: str, folds: int) -> Column:
    """True where crc32 of the id as text leaves 2 modulo ``folds``; false for a null id."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % folds == 2, F.lit(False))


def text_bytes(documents: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, to choose a number of partitions."""
    return documents.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def partitions_for(spark: SparkSession, size: int, each: int) -> int:
    """Partitions of about ``each`` bytes, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins and the last ends.

    A null text has no bytes.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, text: str, size: int = PART_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``size`` bytes of text."""
    data, offsets = utf8(batch.column(text))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield (
            batch.slice(row, end - row),
            data[offsets[row]:offsets[end]],
            offsets[row:end + 1] - offsets[row],
        )
        row = end


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` compressed, for a shuffle that moves all texts."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            small = pa.array([pack.compress(x) for x in
                              batch.column(at).cast(pa.binary()).to_pylist()], pa.binary())
            yield batch.set_column(at, "text", small)

    schema = rows.withColumn("text", F.col("text").cast("binary")).schema
    return rows.mapInArrow(run, schema)


def unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
    unpack = zstandard.ZstdDecompressor()
    at = batch.schema.get_field_index("text")
    plain = pa.array([unpack.decompress(x) for x in batch.column(at).to_pylist()], pa.binary())
    return batch.set_column(at, "text", plain)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A 64-bit word for each byte value.
_BYTE_WORD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


class Substrings:
    """Hashes of any substrings of one array of bytes in constant time each.

    Polynomial over the 64-bit words of the bytes, from running sums; equal bytes
    give equal hashes wherever they stand.
    """

    _power = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Substrings._power) < n:
            for name, base in (("_power", _ODD), ("_inverse", _INVERSE)):
                table = np.full(n, base, np.uint64)
                table[0] = 1
                setattr(Substrings, name, np.multiply.accumulate(table))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_BYTE_WORD[data] * Substrings._power[:n - 1], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * Substrings._inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def hash_all(self, length: int) -> np.ndarray:
        """Of every substring of ``length`` bytes, by its start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        raw = (self.sums[length:] - self.sums[:n]) * Substrings._inverse[:n]
        return mix(raw + np.uint64(length))


#: The bytes that separate words: blank and 0x09 to 0x0D.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and where each text's words begin.

    The third array has one entry more than there are texts.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    black = ~_IS_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = black.copy()
    begins[1:] &= ~black[:-1] | cut[1:n]
    ends = black.copy()
    ends[:-1] &= ~black[1:] | cut[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. count-1 for each count, one after the other."""
    total = int(counts.sum())
    begins = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(begins, counts)
