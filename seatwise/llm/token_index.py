"""Token ids in raw binary shards, with a minimal perfect hash index for keyed access.

``write_shards`` sorts documents by id, encodes them and writes the ids one after the
other as little-endian unsigned integers, a shard file per task. ``write_index`` deals
the keys out to buckets of bounded size and builds a minimal perfect hash for each:
``n`` keys get the slots 0 to n-1, found through a table of seeds. A slot holds the
key's fingerprint, shard, place and length; a key that was never stored has a wrong
fingerprint (but for one in 2**32). ``look_up`` reads keys back through the index.

Both kinds of file lie in a folder that all executors share. A task writes under a name
of its own and renames at the end, and only listed files are read, so a repeated task
does no harm.

Defined results: a null or empty text is its end id alone. Documents of the same doc_id
are told apart by a copy number in the order in which they are stored: equal texts are
then equal rows. A null doc_id is a key like any other and sorts first. An empty table
gives no files and an empty result. Only the named columns are read.

File format. Shard: ids of 2 bytes where all ids of the vocabulary fit, else of 4. Index
bucket: magic, number of keys and seeds, then the arrays seeds, fingerprints (32 bits),
shard numbers (32), first ids (64) and numbers of ids (64).
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatwise.llm.common import mix
from seatwise.llm.warc import folder_of

#: Keys of a bucket on average; a bucket is built and read by one task.
BUCKET_KEYS = 50_000
#: Keys that share a seed on average, and most entries of a worker's table of words.
SEED_KEYS = 4
CACHED_WORDS = 600_000

_MAGIC = b"MPHX"
_MARKS = ".,;:!?%&$*#|()\""
_NULL_KEY = -(1 << 63)
_KEYS = "doc_id bigint, copy bigint, path string, first bigint, n bigint"


class WordIds(dict):
    """Ids, as bytes, of the parts of texts between blanks and line ends.

    The tokenizer drops white space and joins nothing across it, so the ids of a text
    are those of its parts. Nor does it join a letter and the marks in ``_MARKS``, so a
    part that ends in marks is a word and a run of marks. It lowers letters; a text of
    Latin-1 characters is lowered as a whole first, so that fewer words differ. When the
    table is full, further words are encoded where they occur.
    """

    def __init__(self, path: str, width: type):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer, self.width, self.unseen = Tokenizer.from_file(path), width, []
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, words: list[str]) -> None:
        """Words of letters alone are encoded as one text and told apart by their ends."""
        plain = [w for w in words if w.isalpha()]
        # The fast form keeps no offsets, which nothing here reads.
        one, = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)
        ids = np.array(one.ids, self.width)
        ends = (np.flatnonzero(self.ends_word[ids]) + 1) * ids.itemsize
        if len(ends) == len(plain):
            raw, low = ids.tobytes(), 0
            for word, high in zip(plain, ends.tolist(), strict=True):
                self[word] = raw[low:high]
                low = high
        rest = [w for w in words if w not in self]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        for word, one in zip(rest, found, strict=True):
            self[word] = np.array(one.ids, self.width).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        self.unseen, full = [], len(self) >= CACHED_WORDS
        found, unseen = [], []
        for text in texts:  # one look-up a word: those not in the table are listed in passing
            found.append(list(map(self.__getitem__, _lowered(text).replace("\n", " ").split(" "))))
            unseen.append(self.unseen)
            self.unseen = []
        new = set().union(*unseen)
        marked, cut = [w for w in new if w[-1] in _MARKS], []
        whole = new.difference(marked)
        for word in marked:
            stem = word.rstrip(_MARKS)
            # Some letters become a letter and a mark when lowered: such marks join those behind.
            if stem and stem[-1].isalpha() and stem[-1].lower()[-1].isalpha():
                cut.append((word, stem, word[len(stem):]))
                whole.update(cut[-1][1:])
            else:
                whole.add(word)
        whole = [w for w in whole if w not in self]  # ``difference`` would go through the table
        self._learn(whole)
        for word, stem, marks in cut:
            self[word] = self[stem] + self[marks]
        for ids, words in zip(found, unseen, strict=True):
            at = -1
            for word in words:
                at = ids.index(None, at + 1)
                ids[at] = self[word]
        if full:
            for word in new.union(whole):
                self.pop(word, None)
        return list(map(b"".join, found))

    def __missing__(self, word: str) -> None:
        """A word without ids yet; ``encode`` puts them in its place."""
        self.unseen.append(word)


def _lowered(text: str) -> str:
    if "<|" in text:  # a special token is one only as it is written
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


@cache
def _encoder(path: str, width: type) -> WordIds:
    # Spark's tasks share the cores; threads of the library's own would spin beside them.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordIds(path, width)


def id_width(tokenizer_path: str) -> type:
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)
    return np.uint16 if size <= 1 << 16 else np.uint32


def write_shards(documents: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                 width: type, doc_id: str = "doc_id", text: str = "text",
                 partitions: int | None = None) -> DataFrame:
    """Write all documents in ascending order of id; a row per document.

    The result lists doc_id, copy, the shard's path, and first id and number of ids in
    it. Store it before use: each run of it writes new shards.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ("doc_id", "text")
    dealt = rows.repartitionByRange(partitions, "doc_id") if partitions else (
        rows.repartitionByRange("doc_id"))
    end = np.array([end_id], width).tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("path", pa.string()),
                        ("first", pa.int64()), ("n", pa.int64())])

    def write(batches):
        where, base = folder_of(folder)
        encoder, out = _encoder(tokenizer_path, width), None
        name, at, last, copy = f"{base}/{uuid.uuid4().hex}", 0, (), 0
        size, listed = np.dtype(width).itemsize, []
        for batch in batches:
            if out is None and batch.num_rows:
                where.create_dir(base)
                out = where.open_output_stream(f"{name}.part", compression=None)
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    copy = copy + 1 if last == (key,) else 0
                    last = (key,)
                    out.write(ids + end)
                    n = len(ids) // size + 1
                    listed.append((key, copy, f"{name}.ids", at, n))
                    at += n
        if out is not None:
            out.close()
            where.move(f"{name}.part", f"{name}.ids")
            for start in range(0, len(listed), 10_000):
                columns = zip(*listed[start:start + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema)

    return dealt.sortWithinPartitions(*order).mapInArrow(write, _KEYS)


def shard_starts(listed: DataFrame) -> DataFrame:
    """Number and first id of each shard, in ascending order of key: a row per shard."""
    shards = listed.groupBy("path").agg(
        F.min(F.coalesce("doc_id", F.lit(_NULL_KEY))).alias("_least"), F.sum("n").alias("ids"))
    order = Window.orderBy("_least")
    return shards.select(
        "path", "ids", (F.row_number().over(order) - 1).cast("long").alias("shard"),
        (F.sum("ids").over(order) - F.col("ids")).alias("start"))


def _hashes(keys: np.ndarray, copies: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    return mix(mix(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
               + copies.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.atleast_1d(np.asarray(seed, np.uint64)) * np.uint64(0xD1342543DE82EF95))


def build(keys: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds, and the slot of each key, of a minimal perfect hash.

    Keys fall into groups by a first hash. From the largest group on, a group takes the
    first seed that sends all its keys to free and different slots.
    """
    n = len(keys)
    groups = -(-n // SEED_KEYS)
    group = (_hashes(keys, copies, 0) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    begins = np.cumsum(sizes) - sizes
    seeds, slots = np.zeros(groups, np.uint32), np.zeros(n, np.int64)
    free = np.ones(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        if not sizes[g]:
            break
        mine = order[begins[g]:begins[g] + sizes[g]]
        k, c, first = keys[mine], copies[mine], 1
        while True:
            tried = np.arange(first, first + 256, dtype=np.uint64)[:, None]
            spots = (_hashes(k[None, :], c[None, :], tried) % np.uint64(n)).astype(np.int64)
            fits = free[spots].all(axis=1)
            if sizes[g] > 1:
                ordered = np.sort(spots, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if fits.any():
                at = int(np.argmax(fits))
                break
            first += 256
        seeds[g], slots[mine] = first + at, spots[at]
        free[spots[at]] = False
    return seeds, slots


def slots_of(keys: np.ndarray, copies: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    group = (_hashes(keys, copies, 0) % np.uint64(len(seeds))).astype(np.int64)
    return (_hashes(keys, copies, seeds[group]) % np.uint64(n)).astype(np.int64)


def fingerprints(keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
    return (_hashes(keys, copies, 0x5EED) >> np.uint64(32)).astype(np.uint32)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)).cast("int")


def write_index(placed: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write a file per bucket of keys; the result lists bucket, path and keys.

    ``placed`` has doc_id, copy, shard, first and n. Store the result before use.
    """

    def write(key, table):
        where, base = folder_of(folder)
        where.create_dir(base)
        get = lambda name: table.column(name).to_numpy()
        keys, copies = get("key"), get("copy")
        seeds, slots = build(keys, copies)
        columns = []
        for values, kind in ((fingerprints(keys, copies), "<u4"), (get("shard"), "<u4"),
                             (get("first"), "<u8"), (get("n"), "<u8")):
            column = np.zeros(len(keys), kind)
            column[slots] = values
            columns.append(column.tobytes())
        path = f"{base}/{uuid.uuid4().hex}"
        with where.open_output_stream(f"{path}.part", compression=None) as out:
            out.write(_MAGIC + struct.pack("<II", len(keys), len(seeds)))
            out.write(seeds.astype("<u4").tobytes() + b"".join(columns))
        where.move(f"{path}.part", f"{path}.mph")
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()),
                         "index_path": [f"{path}.mph"], "keys": [len(keys)]})

    rows = placed.select(
        _bucket(buckets).alias("bucket"), F.coalesce("doc_id", F.lit(_NULL_KEY)).alias("key"),
        "copy", "shard", "first", "n")
    return rows.groupBy("bucket").applyInArrow(write, "bucket int, index_path string, keys bigint")


class Bucket:
    """A bucket's file in memory, which is bounded by the size of a bucket."""

    def __init__(self, raw: bytes):
        if raw[:4] != _MAGIC:
            raise ValueError("not an index file")
        self.keys, groups = struct.unpack_from("<II", raw, 4)
        at = 12
        arrays = []
        for count, kind in ((groups, "<u4"), (self.keys, "<u4"), (self.keys, "<u4"),
                            (self.keys, "<u8"), (self.keys, "<u8")):
            arrays.append(np.frombuffer(raw, kind, count, at))
            at += arrays[-1].nbytes
        self.seeds, self.prints, self.shards, self.firsts, self.counts = arrays

    def find(self, keys: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether each key is stored, its shard, first id and number of ids."""
        slot = slots_of(keys, copies, self.seeds, self.keys)
        return (self.prints[slot] == fingerprints(keys, copies), self.shards[slot],
                self.firsts[slot], self.counts[slot])


def look_up(keys: DataFrame, index: DataFrame, buckets: int, folder: str) -> DataFrame:
    """doc_id, copy, shard, first and n of the keys (doc_id, copy) that are stored.

    Each task reads the bucket files of its keys, a file at a time.
    """
    wanted = keys.select("doc_id", "copy", _bucket(buckets).alias("bucket")).join(index, "bucket")
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("shard", pa.int64()),
                        ("first", pa.int64()), ("n", pa.int64())])

    def find(batches):
        where, opened, bucket = folder_of(folder)[0], None, None
        for batch in batches:
            paths = batch.column("index_path").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(paths[1:] != paths[:-1]) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if low == high:
                    continue
                if paths[low] != opened:
                    with where.open_input_stream(paths[low], compression=None) as stream:
                        opened, bucket = paths[low], Bucket(stream.read())
                rows = batch.slice(low, high - low)
                ids = rows.column("key").to_numpy()
                copies = rows.column("copy").to_numpy()
                found, shard, first, n = bucket.find(ids, copies)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[found], mask=ids[found] == _NULL_KEY), pa.array(copies[found]),
                    *(pa.array(x[found].astype(np.int64)) for x in (shard, first, n))],
                    schema=schema)

    return (
        wanted.select(F.coalesce("doc_id", F.lit(_NULL_KEY)).alias("key"), "copy", "index_path")
        .sortWithinPartitions("index_path")
        .mapInArrow(find, "doc_id bigint, copy bigint, shard bigint, first bigint, n bigint")
    )


def read_back(found: DataFrame, shards: DataFrame, width: type, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of found keys, from the shard files.

    ``shards`` has path, shard and start. Keys of a shard are read in the order of the
    file; a run of neighbours is read at once, up to a few megabytes.
    """
    size = np.dtype(width).itemsize
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches):
        where, path, stream = folder_of(folder)[0], None, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            rows = []
            for doc_id, name, start, first, n in zip(*columns, strict=True):
                if name != path:
                    if stream is not None:
                        stream.close()
                    path, stream = name, where.open_input_file(name)
                ids = np.frombuffer(stream.read_at(n * size, first * size), width)
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((doc_id, start + first, len(ids), crc))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in
                     zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        if stream is not None:
            stream.close()

    return (
        found.join(shards.select("shard", "path", "start"), "shard")
        .select("doc_id", "path", "start", "first", "n")
        .repartition("path").sortWithinPartitions("path", "first")
        .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // BUCKET_KEYS))
