"""Byte-level BPE: long texts are pre-tokenised in overlapping chunks by many tasks.

A text of more than ``chunk`` characters becomes chunks that overlap by ``overlap``.
Each chunk is pre-tokenised from its own start, which may lie inside a pre-token. Two
neighbours resynchronise at the first place where both begin a pre-token behind a black
character: matching looks only ahead, so from there on both agree. The text is cut at those
places and the pieces are encoded by themselves; their ids follow one another. White space
before a cut would match otherwise at the end of a piece than in the text, where a match
may leave its last character to the word behind, so no piece ends in it. Where two
neighbours find no common place, that text is encoded as one piece. Decoding puts the bytes
of the ids together.

Defined results: a null or empty text has no ids and decodes to no bytes. A null or
repeated doc_id is a text of its own: texts are told apart by row, not by id. An empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a chunk, and by how many it reaches into the next one.
CHUNK = 32_768
OVERLAP = 1_024

_ENCODED = "doc_id bigint, ids binary"
_CHUNKS = "_row bigint, doc_id bigint, i int, last boolean, text string"
_CUT = "_row bigint, doc_id bigint, i int, last boolean, text string, head array<int>, tail array<int>"
_PIECES = "_row bigint, doc_id bigint, i int, ids binary, text string"


@cache
def encoder(ranks_path: str, pattern: str):
    """The tiktoken encoding of a file of ranks, without special tokens."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _matcher(pattern: str):
    import regex

    return regex.compile(pattern)


def boundaries(text: str, pattern: str, ends_here: bool) -> list[int]:
    """The chunk's start, and the starts of its pre-tokens that follow a black character.

    If the text goes on behind the chunk, the last match may be another one in the whole
    text, so only matches that end before the chunk's end count.
    """
    ends = [m.end() for m in _matcher(pattern).finditer(text)]
    return [0, *(e for e in ends if (ends_here or e < len(text)) and not text[e - 1].isspace())]


def _ids(encoding, text: str) -> bytes:
    return np.array(encoding.encode_ordinary(text), np.uint32).tobytes()


def encode(documents: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id",
           text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every text."""
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def whole(batches):
        encoding = encoder(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [_ids(encoding, t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    short = rows.filter(F.length("text") <= chunk).mapInArrow(whole, _ENCODED)
    long = rows.filter(F.length("text") > chunk)
    return short.unionByName(_encode_long(long, ranks_path, pattern, chunk, overlap))


def _encode_long(long: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int,
                 ) -> DataFrame:
    def split(batches):
        for batch in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, start in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pydict({
                        "_row": pa.array([row], pa.int64()), "doc_id": pa.array([doc_id], pa.int64()),
                        "i": pa.array([i], pa.int32()), "last": [start + chunk >= len(text)],
                        "text": [text[start:start + chunk + overlap]],
                    })

    def pretokenise(batches):
        for batch in batches:
            head, tail = [], []
            for last, text in zip(batch.column("last").to_pylist(),
                                  batch.column("text").to_pylist(), strict=True):
                found = boundaries(text, pattern, last)
                head.append([b for b in found if b <= overlap])
                tail.append([b - chunk for b in found if b >= chunk])
            columns = [*batch.columns, pa.array(head, pa.list_(pa.int32())),
                       pa.array(tail, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "head", "tail"])

    chunks = (
        long.withColumn("_row", F.monotonically_increasing_id())
        .select("_row", "doc_id", "text").mapInArrow(split, _CHUNKS)
        .repartition("_row", "i").mapInArrow(pretokenise, _CUT)
    )
    order = Window.partitionBy("_row").orderBy("i")
    begin = F.when(F.col("i") == 0, 0).otherwise(
        F.array_min(F.array_intersect(F.lag("tail").over(order), "head")))
    cut = chunks.withColumn("_begin", begin)
    cut = cut.withColumns({
        "_end": F.when(~F.col("last"), F.lead("_begin").over(order) + chunk),
        "_apart": F.max(F.col("_begin").isNull()).over(Window.partitionBy("_row")),
    })
    piece = F.when(F.col("_apart"), F.expr(f"if(last, text, substring(text, 1, {chunk}))")).otherwise(
        F.expr("substring(text, _begin + 1, coalesce(_end, length(text)) - _begin)"))
    pieces = cut.select("_row", "doc_id", "i", "_apart", piece.alias("text")).repartition("_row", "i")

    def encode_pieces(batches):
        encoding = encoder(ranks_path, pattern)
        for batch in batches:
            apart, texts = batch.column("_apart").to_pylist(), batch.column("text").to_pylist()
            ids = [None if a else _ids(encoding, t) for a, t in zip(apart, texts, strict=True)]
            kept = [t if a else None for a, t in zip(apart, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.binary()), pa.array(kept, pa.string())],
                ["_row", "doc_id", "i", "ids", "text"])

    def together(batches):
        encoding = encoder(ranks_path, pattern)
        for batch in batches:
            for doc_id, found in ((a.as_py(), b.as_py()) for a, b in zip(*batch.columns, strict=True)):
                if found[0]["text"] is None:
                    ids = b"".join(p["ids"] for p in found)
                else:
                    ids = _ids(encoding, "".join(p["text"] for p in found))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([doc_id], pa.int64()), "ids": [ids]})

    return (
        pieces.mapInArrow(encode_pieces, _PIECES)
        .groupBy("_row").agg(
            F.first("doc_id").alias("doc_id"),
            F.sort_array(F.collect_list(F.struct("i", "ids", "text"))).alias("_pieces"))
        .select("doc_id", "_pieces").mapInArrow(together, _ENCODED)
    )


@cache
def _token_bytes(ranks_path: str) -> list[bytes]:
    import base64

    with open(ranks_path, "rb") as lines:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


def _bytes_of(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the decoded bytes of every row of ``encode``."""

    def run(batches):
        table = _token_bytes(ranks_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                data = [_bytes_of(np.frombuffer(x.as_py(), np.uint32), table) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(data, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def digests(encoded: DataFrame, ranks_path: str, keep_ids: bool = False) -> DataFrame:
    """Number of ids, and hex SHA-256 of the decimal ids and of the bytes that they decode to.

    ``keep_ids`` adds the ids themselves, as in ``encode``.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    kept = [("ids", pa.binary())] if keep_ids else []

    def run(batches):
        table = _token_bytes(ranks_path)
        names = [str(i) for i in range(len(table))]
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(raw.as_py(), np.uint32)
                text = " ".join(map(names.__getitem__, ids.tolist()))
                rows.append((doc_id, len(ids), hashlib.sha256(text.encode()).hexdigest(),
                             hashlib.sha256(_bytes_of(ids, table)).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            found = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*found, *(batch.column(1).cast(t) for _, t in kept)],
                [*schema.names, *(name for name, _ in kept)])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
        + (", ids binary" if keep_ids else ""))
