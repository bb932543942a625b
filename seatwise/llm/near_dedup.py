"""Near duplicates by ProbMinHash, banding and verification.

The elements of a text are its shingles of five words, weighted by how often they
occur. Each element has a Poisson process of arrivals whose rate is its weight; each
arrival falls into one of ``REGISTERS`` registers, and a register keeps the element that
came first. Two texts agree in a register with their probability Jaccard similarity.
An element is dropped as soon as its next arrival is later than the latest register.

Copies (texts of equal shingle counts) collapse to their smallest doc_id first. Bands
of ``ROWS`` registers put texts into buckets. Links are verified exactly by weighted
Jaccard similarity of at least ``SIMILARITY`` and only tried between texts that are not
yet in one class:

1. each text with the smallest text of any of its buckets,
2. each text with the smallest text of each of its buckets,
3. in buckets that still hold several classes, with an eighth of the bucket's texts,
   at last with all of them.

Before step 3, texts leave that cannot be similar to any text of another class. What a text
has in common with one of another class is no more than the weight of its shingles that
any text of another class has (its ``shared`` weight), and a similarity of ``SIMILARITY``
takes 0.8/1.8 of the sum of both totals in common. In a large family of texts that resemble
each other somewhat, few are left to be paired, and a pair is made only where the smaller
shared weight is enough, once, in the first bucket that its texts have in common. A pair
whose registers agree in far fewer places (six standard deviations) than at the threshold
is not compared shingle by shingle, nor one whose weights by ``CELLS`` cells of hashes
bound what it has in common below the threshold.

So a bucket of thousands of near copies costs a few comparisons per text, no bucket is
cut, and any two texts of a bucket end in one class or have been compared.

Defined results: a null text, an empty text and one without words has no shingles and is
a class of its own; a text of one to four words is one shingle. Rows of one doc_id are
one document; where their texts differ, one of them, the same each time, stands for all
in each step. A null doc_id is a class of its own per row,
with a null class id. An empty table gives an empty result. Only the named columns are
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import Substrings, mix, parts, ranges, words
from seatwise.operators.key_filter import key_filter, may_occur
from seatwise.operators.matching import attach, having_match

WIDTH = 5
#: 30 bands of 6 registers: of pairs at similarity 0.8, 1 in 10,000 shares no bucket.
REGISTERS = 180
ROWS = 6
SIMILARITY = 0.8
#: Standard deviations of the number of equal registers by which a pair may fall short of
#: what its similarity leads to expect, before the exact comparison is left out.
SLACK = 6.0
#: Bytes of text whose shingles a worker holds at once, at about 48 bytes each.
PASS_BYTES = 1 << 18
#: Cells of a fold, the weights of a text's shingles by the last bits of their hashes. A
#: full cell holds that much or more.
CELLS = 256
FULL = 255
#: Rows of ids in a file of the small tables between steps, and the least number of files.
FILE_ROWS = 250_000
FILES = 4

Keep = Callable[[DataFrame, str], DataFrame]


def in_few_files(keep: Keep, rows: int) -> Keep:
    """``keep`` for tables of up to about ``rows`` rows of ids, dealt to few files.

    Otherwise each task that made some rows writes a file of its own: thousands where a
    skewed join was split. On a local disk Hadoop starts several processes (``chmod``)
    for each; one that is just starting is counted with all memory of its executor.
    """
    files = max(FILES, -(-rows // FILE_ROWS))
    return lambda frame, name: keep(frame.repartition(files), name)


def weighted_shingles(data: np.ndarray, offsets: np.ndarray,
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of every different shingle, by text and hash."""
    starts, ends, begins = words(data, offsets)
    word = Substrings(data).hash(starts, ends)
    n_words = np.diff(begins)
    counts = np.where(n_words >= WIDTH, n_words - WIDTH + 1, n_words > 0).astype(np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(begins[:-1], counts) + ranges(counts)
    left = np.repeat(begins[1:], counts) - first
    shingle = np.zeros(len(first), np.uint64)
    for i in range(WIDTH):
        there = left > i
        part = np.zeros(len(first), np.uint64)
        part[there] = word[first[there] + i]
        shingle = mix(shingle * np.uint64(0x9E3779B97F4A7C15) + part)
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return text[at], shingle[at], np.diff(np.append(at, len(text)))


def _uniform(words: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit words."""
    return ((words >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int,
               ) -> np.ndarray:
    """A row of ``REGISTERS`` words per text; rows of texts without elements are 0."""
    first = np.full(texts * REGISTERS, np.inf)
    winner = np.zeros(texts * REGISTERS, np.uint64)
    seed, time = element.copy(), np.zeros(len(element))
    row, rate, name = text, weight.astype(np.float64), element
    while len(row):
        seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
        time = time - np.log(_uniform(seed)) / rate
        cell = row * REGISTERS + (mix(seed ^ np.uint64(0x5851F42D4C957F2D))
                                  % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(first, cell, time)
        won = first[cell] == time
        winner[cell[won]] = name[won]
        active = time < first.reshape(texts, REGISTERS).max(axis=1)[row]
        seed, time, row, rate, name = (x[active] for x in (seed, time, row, rate, name))
    return winner.reshape(texts, REGISTERS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A word per band: the hash of the band's number and its registers."""
    bands = signature.reshape(len(signature), -1, ROWS)
    key = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64),
                          bands.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return key


_SIGNED = "doc_id bigint, copy_key binary, total bigint, bands array<bigint>, sketch binary"


def signed_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of ``sign`` for a batch of doc_id and text, in passes of ``PASS_BYTES``."""
    for part, data, offsets in parts(batch, "text", PASS_BYTES):
        row, element, weight = weighted_shingles(data, offsets)
        n = part.num_rows
        totals = np.bincount(row, weight, n).astype(np.int64)
        registers = signatures(row, element, weight, n)
        keys, low = band_keys(registers), (mix(registers) & np.uint64(255)).astype(np.uint8)
        # Two sums over all (shingle, count) tell different texts apart.
        one = mix(element + weight.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        two = mix(one ^ np.uint64(0xA0761D6478BD642F))
        begins = np.searchsorted(row, np.arange(n))
        some = np.flatnonzero(totals)
        sums = [np.add.reduceat(x, begins[some]) if len(some) else x for x in (one, two)]
        copies = np.stack(sums, axis=1).astype("<u8") if len(some) else np.zeros((0, 2))
        bands = pa.ListArray.from_arrays(
            pa.array(np.arange(len(some) + 1, dtype=np.int32) * keys.shape[1]),
            pa.array(keys[some].astype(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id").take(pa.array(some)),
            pa.array([c.tobytes() for c in copies], pa.binary()),
            pa.array(totals[some]), bands,
            pa.array([x.tobytes() for x in low[some]], pa.binary())],
            ["doc_id", "copy_key", "total", "bands", "sketch"])


def sign(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, a key that copies share, number of shingles, band keys, a byte per register.

    Texts without shingles are left out.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            yield from signed_parts(batch)

    return rows.filter(F.col("doc_id").isNotNull()).mapInArrow(run, _SIGNED)


def shingle_table(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the different shingles and their counts as packed arrays, and their fold.

    No counts stand for a count of one each.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for part, data, offsets in parts(batch, "text", PASS_BYTES):
                row, element, weight = weighted_shingles(data, offsets)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                folds = folded(row, element, weight, part.num_rows)
                weight = weight.astype("<u4")
                spans = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([element[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([weight[a:b].tobytes() if (weight[a:b] > 1).any() else b""
                              for a, b in spans], pa.binary()),
                    pa.array([x.tobytes() for x in folds], pa.binary())],
                    ["doc_id", "shingles", "counts", "fold"])

    return rows.mapInArrow(run, "doc_id bigint, shingles binary, counts binary, fold binary")


def folded(row: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """A row per text: the 8 bytes of its total weight, then a byte per cell."""
    cell = (mix(element) % np.uint64(CELLS)).astype(np.int64)
    sums = np.bincount(row * CELLS + cell, weight, texts * CELLS).reshape(texts, CELLS)
    totals = sums.sum(axis=1).astype("<i8").view(np.uint8).reshape(texts, 8)
    return np.hstack([totals, np.minimum(sums, FULL).astype(np.uint8)])


def may_be_similar(one: np.ndarray, two: np.ndarray, least: float) -> np.ndarray:
    """False for the pairs of folds whose texts have too little in common for ``least``.

    In a cell they have no more in common than the smaller weight, which is not known
    where both are full. So no pair that is similar is lost.
    """
    total = sum(np.ascontiguousarray(x[:, :8]).view("<i8")[:, 0] for x in (one, two))
    low = np.minimum(one[:, 8:], two[:, 8:])
    most = low.sum(axis=1, dtype=np.int64)
    return (low == FULL).any(axis=1) | (most * (1 + least) >= total * least - 1e-6)


def _counts(packed: bytes, shingles: np.ndarray) -> np.ndarray:
    return np.frombuffer(packed, np.uint32) if packed else np.ones(len(shingles), np.uint32)


def similarity(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> float:
    """Weighted Jaccard similarity of two packed rows."""
    left, right = np.frombuffer(a[0], np.uint64), np.frombuffer(b[0], np.uint64)
    many, more = _counts(a[1], left), _counts(b[1], right)
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    low = int(np.minimum(many[i], more[j]).sum())
    high = int(many.sum(dtype=np.int64)) + int(more.sum(dtype=np.int64)) - low
    return low / high if high else 0.0


def verified(pairs: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are similar."""
    def side(name: str) -> DataFrame:
        return table.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"s{name}"),
                            F.col("counts").alias(f"c{name}"))

    def run(batches):
        for batch in batches:
            u, v, su, cu, sv, cv = batch.columns
            good = [similarity((a.as_py(), b.as_py()), (c.as_py(), d.as_py())) >= least - 1e-12
                    for a, b, c, d in zip(su, cu, sv, cv, strict=True)]
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], ["u", "v"])

    joined = pairs.join(side("u"), "u").join(side("v"), "v")
    return joined.select("u", "v", "su", "cu", "sv", "cv").mapInArrow(run, "u bigint, v bigint")


def promising(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose registers do not rule similarity out."""

    def side(name: str) -> DataFrame:
        return sketches.select(F.col("doc_id").alias(name), F.col("sketch").alias(f"s{name}"))

    joined = pairs.join(side("u"), "u").join(side("v"), "v")
    return agreeing(joined.select("u", "v", "su", "sv"), least)


def agreeing(pairs: DataFrame, least: float) -> DataFrame:
    """u and v of the pairs (u, v, su, sv) whose sketches, and folds if they follow the
    sketches, do not rule similarity out."""
    floor = REGISTERS * least - SLACK * (REGISTERS * least * (1 - least)) ** 0.5

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8)
                            .reshape(batch.num_rows, -1) for i in (2, 3))
                good = (one[:, :REGISTERS] == two[:, :REGISTERS]).sum(axis=1) >= floor
                if one.shape[1] > REGISTERS:
                    good &= may_be_similar(one[:, REGISTERS:], two[:, REGISTERS:], least)
                good = pa.array(good)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(good), batch.column(1).filter(good)], ["u", "v"])

    return pairs.mapInArrow(run, "u bigint, v bigint")


def linkable(texts: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """doc_id and ``shared`` of the texts (doc_id, label, total) that may be similar to one of
    another label.

    ``shared`` is the weight in shingles that a text of another label also has. A similarity
    of ``least`` takes at least that share of a text's weight.
    """

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                shingles = [np.frombuffer(x, np.uint64) for x in part.column(3).to_pylist()]
                counts = [_counts(c, x) for c, x in
                          zip(part.column(4).to_pylist(), shingles, strict=True)]
                sizes = [len(x) for x in shingles]
                rows = [np.repeat(part.column(i).to_numpy(), sizes) for i in range(3)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(shingles).astype(np.int64)),
                    *map(pa.array, rows), pa.array(np.concatenate(counts).astype(np.int64))],
                    ["h", "doc_id", "label", "total", "weight"])

    each = texts.join(table, "doc_id").select(
        "doc_id", "label", "total", "shingles", "counts").mapInArrow(
        run, "h bigint, doc_id bigint, label bigint, total bigint, weight bigint")
    shared = each.groupBy("h").agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
    shared = shared.filter("_low <> _high").select("h", F.lit(True).alias("_shared"))
    common = attach(each.select("h", "doc_id", "total", "weight"), shared, ["h"]).filter("_shared")
    return common.groupBy("doc_id", "total").agg(F.sum("weight").alias("shared")).filter(
        F.col("shared") >= F.col("total") * least - 1e-9).select("doc_id", "shared")


def _enough(shared: Column, totals: Column, least: float) -> Column:
    """Whether two texts with this sum of totals may be similar if they share that weight."""
    return shared * (1 + least) >= totals * least - 1e-6


def _may_link(members: DataFrame, least: float) -> DataFrame:
    """The rows whose bucket may hold a text similar to theirs, by the smallest total and
    the largest shared weight in it."""
    bounds = members.groupBy("bucket").agg(
        F.min("total").alias("_least_total"), F.max("shared").alias("_most_shared"))
    smallest = F.greatest("_least_total", F.col("total") * least)
    return attach(members, bounds, ["bucket"]).filter(_enough(
        F.least("shared", "_most_shared"), F.col("total") + smallest, least)).select(members.columns)


def open_pairs(held: DataFrame, sketches: DataFrame, share: int, least: float) -> DataFrame:
    """u, v and their sketches su, sv of the pairs of the rows (bucket, doc_id, label, total,
    shared) that may be similar: of one bucket and two labels, one of them among a
    ``share``-th of the texts. A pair comes once, from the first of its common buckets."""
    def tried(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(share)) == 0

    buckets = held.groupBy("doc_id").agg(F.collect_set("bucket").alias("near"))
    # The sketches come with the bucket's rows, so pairs that fail move nowhere.
    whole = held.join(sketches.join(buckets, "doc_id"), "doc_id").select(
        "bucket", "doc_id", "label", "total", "shared", "sketch", "near")
    some = whole.filter(tried("doc_id")).select("bucket", *(
        F.col(name).alias(f"_{name}") for name in whole.columns[1:]))
    pairs = whole.join(some, "bucket").filter(
        (F.col("label") != F.col("_label"))
        & ((F.col("doc_id") < F.col("_doc_id")) | ~tried("doc_id"))
        & (F.least("total", "_total") >= F.greatest("total", "_total") * least - 1e-9)
        & _enough(F.least("shared", "_shared"), F.col("total") + F.col("_total"), least)
        & (F.array_min(F.array_intersect("near", "_near")) == F.col("bucket")))
    return pairs.select(F.least("doc_id", "_doc_id").alias("u"), F.greatest("doc_id", "_doc_id").alias("v"),
                        F.col("sketch").alias("su"), F.col("_sketch").alias("sv"))


def merge_classes(labels: DataFrame, links: DataFrame, keep: Keep, name: str) -> DataFrame:
    """Labels (doc_id, label) after all links (u, v); a label is the smallest doc_id.

    Each round hooks every label to its smallest neighbour and follows the hooks to
    their ends, until no link joins two labels. All tables stay distributed.
    """
    side = 0
    while True:
        first = labels.select(F.col("doc_id").alias("u"), F.col("label").alias("a"))
        second = labels.select(F.col("doc_id").alias("v"), F.col("label").alias("b"))
        crossing = links.join(first, "u").join(second, "v").filter("a <> b").select(
            F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        hooks = keep(crossing.groupBy("high").agg(F.min("low").alias("low")), f"{name}-hooks{side}")
        if hooks.isEmpty():
            return labels
        step = 0
        while True:
            nearer = hooks.select(F.col("high").alias("low"), F.col("low").alias("_next"))
            jumped = keep(hooks.join(nearer, "low", "left").select(
                "high", F.coalesce("_next", "low").alias("low"),
                F.col("_next").isNotNull().alias("_moved")), f"{name}-jump{side}-{step}")
            hooks = jumped.select("high", "low")
            if jumped.filter("_moved").isEmpty():
                break
            step += 1
        labels = keep(
            labels.join(hooks.withColumnRenamed("high", "label"), "label", "left")
            .select("doc_id", F.coalesce("low", "label").alias("label")), f"{name}-labels{side}")
        side += 1


def classes(documents: DataFrame, keep: Keep, doc_id: str = "doc_id", text: str = "text",
            least: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its class) of every document."""
    signed = keep(
        sign(documents, doc_id, text).groupBy("doc_id")
        .agg(F.max(F.struct("copy_key", "total", "bands", "sketch")).alias("_s"))
        .select("doc_id", "_s.*"),
        "signed")
    few = in_few_files(keep, signed.count())
    # ``attach`` keeps the join splittable where very many texts are copies of one.
    copies = few(
        attach(signed.select("doc_id", "copy_key"),
               signed.groupBy("copy_key").agg(F.min("doc_id").alias("rep")), ["copy_key"])
        .select("doc_id", "rep"), "copies")
    firsts = signed.join(copies.filter("doc_id = rep").select("doc_id"), "doc_id", "left_semi")
    members = firsts.select("doc_id", "total", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("doc_id").alias("center"), F.count("doc_id").alias("n"))
    shared = few(shared.filter("n > 1"), "buckets")
    members = keep(
        members.join(shared, "bucket").select("bucket", "doc_id", "center", "total"), "members")
    candidates = members.select("doc_id").distinct()
    # Most texts are no candidates; the bitmaps keep them out of the exact joins' shuffles.
    known = key_filter(candidates, ["doc_id"], keep, "candidates")
    source = may_occur(documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), known)
    table = keep(
        shingle_table(source.join(candidates, "doc_id", "left_semi")).groupBy("doc_id")
        .agg(F.max(F.struct("shingles", "counts", "fold")).alias("_t")).select("doc_id", "_t.*"), "shingles")
    labels = few(candidates.select("doc_id", F.col("doc_id").alias("label")), "labels")

    sketches = keep(
        may_occur(signed.select("doc_id", "sketch"), known).join(candidates, "doc_id", "left_semi"),
        "sketches")

    def merged(labels: DataFrame, likely: DataFrame, name: str) -> DataFrame:
        found = few(verified(few(likely, f"{name}-likely"), table, least), f"{name}-links")
        return merge_classes(labels, found, few, name)

    others = members.filter("doc_id <> center")
    nearest = others.groupBy("doc_id").agg(F.min("center").alias("v"))
    nearest = nearest.select(F.col("doc_id").alias("u"), "v")
    labels = merged(labels, promising(nearest, sketches, least), "nearest")
    apart = _apart(others.select(F.col("doc_id").alias("u"), F.col("center").alias("v")).distinct(), labels)
    labels = merged(labels, promising(apart, sketches, least), "centers")

    # Buckets that still hold several classes: compare with 1/8 of their texts, then
    # with all of them, always only across classes.
    held = few(_in_open_buckets(members.join(labels, "doc_id")), "open")
    for turn in range(2):  # texts that leave may leave others without a partner
        if not held.isEmpty():
            texts = held.select("doc_id", "label", "total").distinct()
            able = few(linkable(texts, table, least), f"able{turn}")
            held = _may_link(held.drop("shared").join(able, "doc_id"), least)
            held = few(_in_open_buckets(held), f"left{turn}")
    folds = table.select("doc_id", "fold")
    marks = sketches.join(folds, "doc_id").select("doc_id", F.concat("sketch", "fold").alias("sketch"))
    for share in (8, 1):
        if held.isEmpty():
            break
        if share == 1:
            held = few(_in_open_buckets(held.drop("label").join(labels, "doc_id")), "last")
        pairs = open_pairs(held, marks, share, least)
        labels = merged(labels, agreeing(pairs, least), f"open{share}")

    known = copies.join(labels.select(F.col("doc_id").alias("rep"), "label"), "rep", "left").select(
        "doc_id", F.coalesce("label", "rep").alias("class_id"))
    ids = documents.select(F.col(doc_id).cast("long").alias("doc_id"))
    return ids.join(known, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def _in_open_buckets(members: DataFrame) -> DataFrame:
    """The rows of buckets that hold texts of several labels; a hot bucket can be split."""
    several = members.groupBy("bucket").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low <> _high")
    return having_match(members, several, ["bucket"])


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose texts are in different classes."""
    first = labels.select(F.col("doc_id").alias("u"), F.col("label").alias("_a"))
    second = labels.select(F.col("doc_id").alias("v"), F.col("label").alias("_b"))
    return pairs.join(first, "u").join(second, "v").filter("_a <> _b").select("u", "v")


def representatives(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One document, all columns, of each class; rows without an id all stay."""
    first = found.filter("doc_id = class_id").select(F.col("doc_id").alias("_first")).distinct()
    named = documents.filter(F.col(doc_id).isNotNull()).join(
        first, F.col(doc_id) == F.col("_first"), "left_semi").dropDuplicates([doc_id])
    return named.unionByName(documents.filter(F.col(doc_id).isNull()))
