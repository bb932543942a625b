"""Removal of byte strings that also occur in an earlier document.

Prefix doubling ranks positions by ever longer prefixes and goes on only with those that
are not yet unique. Ranking every position of the corpus in each round would move many
times its size, so the rounds start from anchors: of every string of ``least`` bytes the
prefix of 16 bytes with the smallest hash, leftmost among equals. Equal strings have
equal anchors at equal places, so no repeat is lost. Spark deals (rank, position) pairs
out by rank and each round sorts them:

1. anchors by their 16 bytes; those found in one document alone are unique and leave;
2. the others by all the bytes of the strings that share the anchor (up to 84): if a
   smaller document has the same, all these strings are repeats, and leave; else by the
   33 bytes that end or begin with the anchor, one of which is in every string of the
   anchor: a side that no other document has (by a fingerprint) leaves;
3. what is left, where two copies part, by the strings of ``least`` bytes themselves.

Ranks are 64-bit hashes of the bytes. Before pairs are moved a task drops those that
repeat within it from a smaller document, so a passage that very many documents share
costs a few pairs per task.

Defined results: a null text is empty; a text shorter than ``least`` loses nothing. A
null doc_id is smaller than all others. Rows of one doc_id never remove bytes of one
another; equal rows get equal results. An empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import Substrings, mix, packed, parts, ranges, text_bytes, unpacked

LEAST = 50
ANCHOR = 16
#: Bytes of text whose pairs one task sorts.
TASK_BYTES = 8 << 20
#: Bytes of text within which repeats are dropped before pairs are moved.
BLOCK_BYTES = 2 << 20
#: Bytes of text hashed at once; the arrays of a pass take about a hundred times that.
PASS_BYTES = 256 << 10

Keep = Callable[[DataFrame, str], DataFrame]

_NULL_ID = -(1 << 63)
#: A document in a block of pairs: its id, a hash of its text, and how many pairs it has.
_DOC = np.dtype([("id", "<i8"), ("text", "<i4"), ("n", "<u4")])
_BLOCK = "bucket int, done boolean, docs binary, data binary"
_FOUND = "doc_id bigint, text_key int, spans binary, open binary"


def runs(data: np.ndarray, offsets: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring strings of ``least`` bytes with one anchor.

    By run: document, hash of the anchor, hash of all the run's bytes, start in the
    document, number of strings, place of the anchor in the run, and fingerprints of the
    half strings that end and begin with the anchor (0 where the document has none).
    """
    none = {name: np.zeros(0, kind) for name, kind in (
        ("doc", np.int64), ("anchor", np.uint64), ("whole", np.uint64), ("start", np.int64),
        ("count", np.int64), ("place", np.int64), ("left", np.uint8), ("right", np.uint8))}
    if len(data) < least:
        return none
    sums = Substrings(data)
    anchor = sums.hash_all(ANCHOR)
    low = anchor & np.uint64(0xFFFFFFFF00000000) | np.arange(len(anchor), dtype=np.uint64)
    span, width = least - ANCHOR + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:-(span - width)], low[span - width:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lengths = np.diff(offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    ok = lengths >= least
    np.add.at(inside, offsets[:-1][ok], 1)
    np.add.at(inside, offsets[1:][ok] - least + 1, -1)
    valid = np.cumsum(inside[:len(at)], dtype=np.int8).astype(bool)
    where = np.flatnonzero(valid)
    if not len(where):
        return none
    new = np.ones(len(where), bool)
    new[1:] = (at[where[1:]] != at[where[:-1]]) | (where[1:] != where[:-1] + 1)
    first = np.flatnonzero(new)
    start, count = where[first], np.diff(np.append(first, len(where)))
    place = at[start]
    whole = mix(sums.hash(start, start + count + least - 1) + (place - start).astype(np.uint64))
    doc = np.searchsorted(offsets, start, "right") - 1
    half = (least - ANCHOR) // 2
    sides = {}
    for name, a, b in (("left", place - half, place + ANCHOR), ("right", place, place + ANCHOR + half)):
        there = (a >= offsets[doc]) & (b <= offsets[doc + 1])
        sides[name] = np.zeros(len(doc), np.uint8)
        sides[name][there] = 1 + sums.hash(a[there], b[there]) % np.uint64(255)
    return {"doc": doc, "anchor": anchor[place], "whole": whole, "start": start - offsets[doc],
            "count": count, "place": place - start, **sides}


def _passes(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last document of stretches of about ``PASS_BYTES``."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + PASS_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def block_runs(data: np.ndarray, offsets: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """The ``runs`` of a block of documents, found a few documents at a time."""
    found = []
    for low, high in _passes(offsets):
        some = runs(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], least)
        found.append(some | {"doc": some["doc"] + low})
    return {name: np.concatenate([some[name] for some in found]) for name in found[0]}


def _pack(bucket: np.ndarray, doc: np.ndarray, docs: np.ndarray, columns: list[np.ndarray],
          done: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of pairs, one per bucket: its documents, then the columns."""
    if not len(doc):
        return
    order = np.lexsort((doc, bucket))
    bucket, doc, columns = bucket[order], doc[order], [c[order] for c in columns]
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    rows: tuple[list, list, list] = ([], [], [])
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        mine, counts = np.unique(doc[low:high], return_counts=True)
        table = docs[mine]
        table["n"] = counts
        rows[0].append(int(bucket[low]))
        rows[1].append(table.tobytes())
        rows[2].append(b"".join(c[low:high].tobytes() for c in columns))
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), pa.array([done] * len(rows[0])),
         pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())],
        ["bucket", "done", "docs", "data"])


def _unpack(docs: list[bytes], data: list[bytes], kinds: list[str]) -> tuple[np.ndarray, list]:
    """All pairs of several blocks: the document of each, and the columns."""
    tables, columns = [], [[] for _ in kinds]
    for one, raw in zip(docs, data, strict=True):
        table = np.frombuffer(one, _DOC)
        n, at = int(table["n"].sum()), 0
        tables.append(np.repeat(table, table["n"]))
        for column, kind in zip(columns, kinds, strict=True):
            column.append(np.frombuffer(raw, kind, n, at))
            at += column[-1].nbytes
    if not tables:
        return np.zeros(0, _DOC), [np.zeros(0, k) for k in kinds]
    return np.concatenate(tables), [np.concatenate(c) for c in columns]


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document in order; overlapping and touching ones are one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # Ends grow within a document once they are carried along; shift documents apart.
    number = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    shift = number * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, (start + shift)[1:] > reach[:-1])
    new[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], (reach - shift)[last]


def _repeats(rank: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by rank and id, the group of each pair in that order, and each group's
    smallest id."""
    order = np.lexsort((ids, *reversed(rank)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for r in rank:
        r = r[order]
        new[1:] |= r[1:] != r[:-1]
    group = np.cumsum(new) - 1
    return order, group, ids[order][np.flatnonzero(new)] if len(order) else ids


def _different(*columns: np.ndarray) -> np.ndarray:
    """For each row: how many values the last column has (up to 2) where the others are
    those of the row."""
    *keys, value = columns
    order = np.lexsort((value, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(order)) - 1
    several = value[order[at]] != value[order[ends]] if len(order) else np.zeros(0, bool)
    out = np.empty(len(order), np.int64)
    out[order] = 1 + several[np.cumsum(new) - 1]
    return out


def _docs_of(part: pa.RecordBatch) -> np.ndarray:
    docs = np.zeros(part.num_rows, _DOC)
    docs["id"] = part.column("doc_id").to_numpy(zero_copy_only=False)
    docs["text"] = part.column("text_key").to_numpy(zero_copy_only=False)
    return docs


def _rows(doc: np.ndarray, spans: tuple, edges: tuple) -> Iterator[pa.RecordBatch]:
    """A row per document: its spans (start, end) and open runs (start, count)."""
    keys = np.concatenate([spans[0], edges[0]])
    if not len(keys):
        return
    names = np.unique(keys)
    out = []
    for which, a, b in (spans, edges):
        order = np.argsort(which, kind="stable")
        pairs = np.stack([a[order], b[order]], axis=1).astype("<u4")
        cuts = np.append(np.searchsorted(which[order], names), len(which))
        out.append(pa.array([pairs[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)],
                            pa.binary()))
    for low in range(0, len(names), 5_000):
        some = names[low:low + 5_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc["id"][some]), pa.array(doc["text"][some]),
             *(x.slice(low, 5_000) for x in out)], ["doc_id", "text_key", "spans", "open"])


def _deal(names: np.ndarray, spans: tuple, edges: tuple, blocks: int) -> Iterator[pa.RecordBatch]:
    """Spans and open runs of many documents, to be gathered by document."""
    for (doc, a, b), done in ((spans, True), (edges, False)):
        yield from _pack(names["text"][doc].astype(np.int64) % blocks, doc, names,
                         [a.astype("<u4"), b.astype("<u4")], done)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from the blocks of a task."""
    held: dict[bool, list[tuple[list, list]]] = {True: [], False: []}
    for batch in batches:
        done = batch.column("done")
        for flag, mask in ((True, done), (False, pc.invert(done))):
            some = batch.filter(mask)
            held[flag].append((some.column("docs").to_pylist(), some.column("data").to_pylist()))
    found = {flag: _unpack([x for docs, _ in blocks for x in docs],
                           [x for _, data in blocks for x in data], ["<u4", "<u4"])
             for flag, blocks in held.items()}
    names, number = _number(np.concatenate([found[True][0], found[False][0]]))
    split = len(found[True][0])
    spans = _merged(number[:split], *(x.astype(np.int64) for x in found[True][1]))
    yield from _rows(names, spans, (number[split:], *found[False][1]))


def _number(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different documents, and the number of each row's among them."""
    keys = np.stack([docs["id"], docs["text"].astype(np.int64)], axis=1)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return docs[order[new]], number


def keyed(documents: DataFrame, doc_id: str, text: str, *others: Column) -> DataFrame:
    """Rows under the keys of this module: doc_id without nulls and a hash of the text."""
    return documents.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc_id"),
        F.hash(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), *others)


def _first_rounds(rows: DataFrame, buckets: int, blocks: int, least: int) -> DataFrame:
    """Rounds 1 and 2: repeats for certain, and runs that need round 3."""
    kinds = ["<u4", "<u8", "<u4", "u1", "u1", "u1", "u1"]
    half = (least - ANCHOR) // 2

    def anchors(batches):
        for batch in batches:
            for part, data, offsets in parts(batch, "text", BLOCK_BYTES):
                docs = _docs_of(part)
                found = block_runs(data, offsets, least)
                doc, start, count = found["doc"], found["start"], found["count"]
                order, group, smallest = _repeats([found["whole"]], docs["id"][doc])
                later = np.zeros(len(doc), bool)
                later[order] = docs["id"][doc[order]] > smallest[group]
                spans = _merged(doc[later], start[later],
                                start[later] + count[later] + least - 1)
                yield from _pack(docs["text"][spans[0]].astype(np.int64) % buckets, spans[0], docs,
                                 [spans[1].astype("<u4"), spans[2].astype("<u4")], True)
                left = ~later
                anchor = found["anchor"][left]
                yield from _pack(
                    (anchor % np.uint64(buckets)).astype(np.int64), doc[left], docs,
                    [(anchor >> np.uint64(32)).astype("<u4"), found["whole"][left].astype("<u8"),
                     start[left].astype("<u4"),
                     *(found[x][left].astype("u1") for x in ("count", "place", "left", "right"))],
                    False)

    def sort(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            done = batch.column("done")
            other = batch.filter(done)
            docs, (start, end) = _unpack(other.column("docs").to_pylist(),
                                         other.column("data").to_pylist(), ["<u4", "<u4"])
            names, number = _number(docs)
            none = np.zeros(0, np.int64)
            yield from _deal(names, (number, start, end), (none, none, none), blocks)
            held.append(batch.filter(pc.invert(done)))
        docs, columns = _unpack([x for b in held for x in b.column("docs").to_pylist()],
                                [x for b in held for x in b.column("data").to_pylist()], kinds)
        held.clear()
        anchor, whole, start, count, place, left, right = columns
        ids = docs["id"]
        # Round 1: an anchor of one document alone leaves.
        order, group, smallest = _repeats([anchor], ids)
        largest = np.full(len(smallest), _NULL_ID, np.int64)
        np.maximum.at(largest, group, ids[order])
        keep = np.sort(order[(largest > smallest)[group]])
        docs, anchor, whole, start, count, place, left, right = (
            x[keep] for x in (docs, anchor, whole, start, count, place, left, right))
        ids = docs["id"]
        # Round 2: the whole run in a smaller document.
        order, group, smallest = _repeats([anchor, whole], ids)
        later = np.zeros(len(ids), bool)
        later[order] = ids[order] > smallest[group]
        # First runs whose anchor has no other whole run need nothing more. Of the rest,
        # a string has ``half`` bytes on one side of its anchor at least.
        first = ~later & (_different(anchor, whole) > 1)
        near = _different(anchor[first], left[first], whole[first]) > 1
        far = _different(anchor[first], right[first], whole[first]) > 1
        near &= left[first] > 0
        far &= right[first] > 0
        begin, place = start.astype(np.int64), place.astype(np.int64)
        count = count.astype(np.int64)
        lows = begin[first] + np.where(near, 0, np.maximum(place[first] - half + 1, 0))
        highs = begin[first] + np.where(
            far, count[first], np.clip(place[first] - half + 1, 0, count[first]))
        some = (near | far) & (highs > lows)
        edge = np.flatnonzero(first)[some]
        names, number = _number(docs)
        yield from _deal(
            names, (number[later], begin[later], begin[later] + count[later] + least - 1),
            (number[edge], lows[some], (highs - lows)[some]), blocks)

    return (
        rows.select("doc_id", "text_key", "text").mapInArrow(anchors, _BLOCK)
        .repartition(buckets, "bucket").mapInArrow(sort, _BLOCK)
        .repartition(blocks, "bucket").mapInArrow(_gather, _FOUND)
    )


def _last_round(rows: DataFrame, open_runs: DataFrame, buckets: int, blocks: int, least: int,
                ) -> DataFrame:
    """Round 3: the strings of open runs; ``open_runs`` has doc_id, text_key and ``open``."""
    kinds = ["<u8", "<u4"]

    def strings(batches):
        for batch in batches:
            for part, data, offsets in parts(unpacked(batch), "text", BLOCK_BYTES):
                docs = _docs_of(part)
                pairs = [np.frombuffer(x, "<u4").reshape(-1, 2).astype(np.int64) for x in part.column("open").to_pylist()]
                doc = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
                start, count = np.concatenate(pairs).T if pairs else np.zeros((2, 0), np.int64)
                doc, start = np.repeat(doc, count), np.repeat(start, count) + ranges(count)
                begin, rank = offsets[doc] + start, np.empty(len(doc), np.uint64)
                for low, high in _passes(offsets):
                    some = slice(*np.searchsorted(doc, (low, high)))
                    at = begin[some] - offsets[low]
                    rank[some] = Substrings(data[offsets[low]:offsets[high]]).hash(at, at + least)
                order, group, smallest = _repeats([rank], docs["id"][doc])
                later = np.zeros(len(doc), bool)
                later[order] = docs["id"][doc[order]] > smallest[group]
                spans = _merged(doc[later], start[later], start[later] + least)
                yield from _pack(docs["text"][spans[0]].astype(np.int64) % buckets, spans[0], docs,
                                 [spans[1].astype("<u4"), spans[2].astype("<u4")], True)
                left = ~later
                yield from _pack((rank[left] % np.uint64(buckets)).astype(np.int64), doc[left], docs,
                                 [rank[left].astype("<u8"), start[left].astype("<u4")], False)

    def sort(batches):
        held: list[pa.RecordBatch] = []
        none = np.zeros(0, np.int64)
        for batch in batches:
            done = batch.column("done")
            other = batch.filter(done)
            docs, (start, end) = _unpack(other.column("docs").to_pylist(),
                                         other.column("data").to_pylist(), ["<u4", "<u4"])
            names, number = _number(docs)
            yield from _deal(names, (number, start, end), (none, none, none), blocks)
            held.append(batch.filter(pc.invert(done)))
        docs, (rank, start) = _unpack([x for b in held for x in b.column("docs").to_pylist()],
                                      [x for b in held for x in b.column("data").to_pylist()], kinds)
        held.clear()
        order, group, smallest = _repeats([rank], docs["id"])
        later = order[docs["id"][order] > smallest[group]]
        names, number = _number(docs[later])
        begin = start[later].astype(np.int64)
        yield from _deal(names, _merged(number, begin, begin + least), (none, none, none), blocks)

    return (
        packed(rows.select("doc_id", "text_key", "text")).join(open_runs, ["doc_id", "text_key"])
        .mapInArrow(strings, _BLOCK)
        .repartition(buckets, "bucket").mapInArrow(sort, _BLOCK)
        .repartition(blocks, "bucket").mapInArrow(_gather, _FOUND)
    )


def repeated_spans(documents: DataFrame, keep: Keep, doc_id: str = "doc_id", text: str = "text",
                   least: int = LEAST) -> DataFrame:
    """doc_id, text_key and ``spans``: packed (start, end) of bytes to remove, in any order.

    A document may have two rows, and its spans may overlap.
    """
    if least < 2 * ANCHOR or least - ANCHOR + 1 > 255:
        raise ValueError(f"strings of {2 * ANCHOR} to {ANCHOR + 254} bytes only")
    rows = keyed(documents, doc_id, text)
    size = text_bytes(rows)
    buckets = max(12, -(-size // TASK_BYTES))
    blocks = 2 * buckets
    found = keep(_first_rounds(rows, buckets, blocks, least), "rounds12")
    open_runs = found.filter(F.octet_length("open") > 0).select("doc_id", "text_key", "open")
    strings = keep(_last_round(rows, open_runs, buckets, blocks, least), "round3")
    return found.unionByName(strings).filter(F.octet_length("spans") > 0).select(
        "doc_id", "text_key", "spans")


def with_spans(documents: DataFrame, spans: DataFrame, doc_id: str, text: str, *others: Column,
               ) -> DataFrame:
    """doc_id, the other columns asked for, text (compressed), and ``_spans``."""
    listed = spans.groupBy("doc_id", "text_key").agg(F.collect_list("spans").alias("_spans"))
    rows = packed(keyed(documents, doc_id, text, *others))
    return rows.join(listed, ["doc_id", "text_key"], "left").drop("text_key")


def _cut(data: bytes, packed: list[bytes] | None, whole_characters: bool,
         ) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many spans."""
    if not packed:
        return data, 0, 0
    pairs = np.frombuffer(b"".join(packed), "<u4").reshape(-1, 2).astype(np.int64)
    _, start, end = _merged(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
    kept, at, gone, spans = [], 0, 0, 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        if whole_characters:  # bytes of characters that are not removed whole stay
            while a < b and data[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                b -= 1
        kept.append(data[at:a])
        at, gone, spans = b, gone + b - a, spans + (b > a)
    kept.append(data[at:])
    return b"".join(kept), gone, spans


def digests(documents: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text",
            ) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and SHA-256 of the bytes left, of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, data, packed in zip(
                    batch.column("doc_id").to_pylist(),
                    map(unpack.decompress, batch.column("text").to_pylist()),
                    batch.column("_spans").to_pylist(), strict=True):
                left, gone, spans = _cut(data, packed, False)
                rows.append((None if doc_id == _NULL_ID else doc_id, len(data), gone, spans,
                             hashlib.sha256(left).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = with_spans(documents, spans, doc_id, text).select("doc_id", "text", "_spans")
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                "kept_sha256 string")


def removed(documents: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text",
            ) -> DataFrame:
    """The documents, all columns, with the spans cut from their texts.

    A character that a span cuts through stays whole. A null text stays null.
    """
    at = documents.columns.index(text)
    others = F.struct(*(
        F.isnull(F.col(c)).alias(f"c{i}") if i == at else F.col(c).alias(f"c{i}")
        for i, c in enumerate(documents.columns)))
    joined = with_spans(documents, spans, doc_id, text, others.alias("_row"))
    flat = joined.select(*(F.col(f"_row.c{i}") for i in range(len(documents.columns))),
                         "text", "_spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            left = [None if gone else _cut(unpack.decompress(t), s, True)[0].decode()
                    for gone, t, s in zip(*(batch.column(c).to_pylist() for c in
                                            (at, "text", "_spans")), strict=True)]
            columns = list(batch.columns[:-2])
            columns[at] = pa.array(left, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-2])

    schema = flat.drop("text", "_spans").withColumn(f"c{at}", F.lit(None).cast("string")).schema
    return flat.mapInArrow(run, schema).toDF(*documents.columns)
