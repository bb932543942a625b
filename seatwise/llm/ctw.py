"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions. A decision is predicted from the bytes before it by
Krichevsky-Trofimov estimates at all depths from 0 to ``DEPTH``: the estimate of a node
and the mixture of its children weigh by how well each coded the training texts. The
product over the bits is the probability of the byte, so a text's score is its code
length.

The tree has every context of the training texts, however many. Its counts are a table,
weighted from the longest contexts up and mixed from the root down in subtrees and, above
those, by one ``groupBy`` and one join a depth; neither the driver nor a worker holds it. The grams of texts
that are only scored are in it with a count of 0, which changes no estimate: a context
never seen gives even odds. Texts are dealt into blocks of ``BLOCK`` bytes; the different
grams of a block are joined with their log probabilities and meet the block's texts in
one task, which so holds no more grams than the block has bytes.

The base score needs the count of every word. The ``FREQUENT`` most frequent words of
at most ``SENT_BYTES`` bytes go to every task; all other words are joined with the counts.

Defined results: a null text is empty: it has the end token and the end symbol. Nothing
to learn from gives even odds for every bit, and base log10(1 / 1) for an empty V and N.
A null doc_id trains. Repeated rows are scored and counted each. An empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import packed, partitions_for, parts, ranges, text_bytes, unpacked

DEPTH = 5
#: Bytes of text whose different grams are looked up together.
BLOCK = 24 << 20
#: Bytes of a context whose subtree of longer contexts is weighed in one task: at most
#: 256 to the power of DEPTH - CUT contexts, whatever the input.
CUT = 3
FREQUENT = 1 << 18
#: Longer words are joined, however frequent.
SENT_BYTES = 64
#: Ends a text; no byte of UTF-8.
END = 0xFF
#: Different words that a task counts before it hands them on.
HELD_WORDS = 300_000
#: Grams that a task gathers at least before it merges equal ones.
HELD_GRAMS = 500_000
#: Grams that a task hands on at once, and bytes of text in one numpy pass; the arrays of
#: a pass take about a hundred times that.
HANDED_GRAMS = 100_000
PASS_BYTES = 256 << 10
#: Texts that a task decompresses at once.
UNPACKED_ROWS = 500

Keep = Callable[[DataFrame, str], DataFrame]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts, each behind ``DEPTH`` end symbols and before one.

    Returns the bytes, the places to predict, and where each text's places begin.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    shift = np.repeat((np.arange(n) + 1) * (DEPTH + 1) - 1, lengths)
    out = np.full(len(data) + n * (DEPTH + 1), END, np.uint8)
    out[np.arange(len(data)) + shift] = _LOWER[data]
    begins = offsets[:-1] + np.arange(n) * (DEPTH + 1) + DEPTH
    at = np.repeat(begins, lengths + 1) + ranges(lengths + 1)
    return out, at, np.append(offsets[:-1] + np.arange(n), len(at))


def grams_at(seen: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each place's byte and the ``DEPTH`` bytes before it, as one number, the byte lowest."""
    gram = np.zeros(max(len(seen) - DEPTH, 0), np.uint64)  # of every place from DEPTH on
    for back in range(DEPTH, -1, -1):
        gram = gram << np.uint64(8) | seen[DEPTH - back:len(seen) - back]
    return gram[at - DEPTH]


class GramTable:
    """Log probabilities of different grams, found by hashing with linear probing.

    At least half of the cells are free, so that most look-ups end in the first cell.
    """

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        self.bits = (2 * len(grams)).bit_length() + 1
        self.grams = np.full(1 << self.bits, -1, np.int64)
        self.logs = np.zeros(1 << self.bits, np.float32)
        at = self._first(grams)
        while len(grams):
            free = self.grams[at] < 0
            self.grams[at[free]] = grams[free]  # of several, one gets the cell
            placed = self.grams[at] == grams
            self.logs[at[placed]] = logs[placed]
            grams, logs = grams[~placed], logs[~placed]
            at = self._next(at[~placed])

    def _first(self, grams: np.ndarray) -> np.ndarray:
        spread = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The log of each gram; one that is not in the table raises KeyError."""
        at = self._first(grams)
        on = np.flatnonzero(self.grams.take(at) != grams)
        while len(on):
            if (self.grams.take(at.take(on)) < 0).any():
                raise KeyError("a gram without a probability")
            at[on] = there = self._next(at.take(on))
            on = on.take(np.flatnonzero(self.grams.take(there) != grams.take(on)))
        return self.logs.take(at)


def blocks(rows: DataFrame) -> DataFrame:
    """_row, block, doc_id, held_out, text: rows one after the other in blocks of ``BLOCK`` bytes."""

    def run(batches):
        first, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ends = before + np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(
                zero_copy_only=False).astype(np.int64))
            starts = np.append(before, ends[:-1])
            before = int(ends[-1]) if len(ends) else before
            whole = pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(first + starts // BLOCK),
                 *(batch.column(c) for c in ("doc_id", "held_out", "text"))],
                ["_row", "block", "doc_id", "held_out", "text"])
            yield from (part for part, _, _ in parts(whole, "text"))

    return rows.select(F.monotonically_increasing_id().alias("_row"), "*").mapInArrow(
        run, "_row bigint, block bigint, doc_id bigint, held_out boolean, text string")


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else values[:0]


def block_grams(dealt: DataFrame) -> DataFrame:
    """block, gram, n: the different grams of each block, and how often training texts have them.

    A block that two tasks read has its common grams twice.
    """

    def count(batches):
        block, grams, counts = None, [], []

        def merge():
            gram, n = np.concatenate(grams), np.concatenate(counts)
            order = np.argsort(gram, kind="stable")
            gram, n = gram[order], n[order]
            first = _runs(gram)
            grams[:], counts[:] = [gram[first]], [np.add.reduceat(n, first)]

        def flush():
            merge()
            gram, n = grams.pop(), counts.pop()
            for low in range(0, len(gram), HANDED_GRAMS):
                some = gram[low:low + HANDED_GRAMS].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), block)), pa.array(some),
                     pa.array(n[low:low + HANDED_GRAMS])], ["block", "gram", "n"])

        for batch in batches:
            for low, high, number in _stretches(batch.column("block").to_numpy()):
                if number != block and grams:
                    yield from flush()
                block = number
                for part, data, offsets in parts(batch.slice(low, high - low), "text", PASS_BYTES):
                    seen, at, begins = symbols(data, offsets)
                    # The lowest bit tells held out places, which count 0.
                    held = part.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint64)
                    key = grams_at(seen, at) << np.uint64(1) | np.repeat(held, np.diff(begins))
                    key.sort()
                    first = _runs(key)
                    n = np.diff(np.append(first, len(key)))
                    key = key[first]
                    n[(key & np.uint64(1)).astype(bool)] = 0
                    grams.append(key >> np.uint64(1))
                    counts.append(n)
                    if sum(map(len, grams[1:])) > max(HELD_GRAMS, len(grams[0])):
                        merge()
        if grams:
            yield from flush()

    return dealt.select("block", "held_out", "text").mapInArrow(
        count, "block bigint, gram bigint, n bigint")


def _stretches(values: np.ndarray):
    """Begin, end and value of each run of equal values."""
    first = _runs(values)
    for low, high in zip(first.tolist(), [*first[1:].tolist(), len(values)], strict=True):
        yield low, high, int(values[low])


def _raised(gram: np.ndarray, n: np.ndarray) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """The levels from ``DEPTH`` up to ``CUT`` of whole subtrees, weighted.

    A level: keys, zeros, ones, log of the whole probability, share of the node's own
    estimate, and the place of each key of the level below. Then the place in the deepest
    level of each gram's eight decisions, and whether each decided for one.
    """
    byte = gram & 255
    rows = [(gram >> 8 << 8) + (1 << b) + (byte >> (8 - b)) for b in range(8)]
    bit = np.stack([byte >> (7 - b) & 1 for b in range(8)], 1).astype(bool)
    keys, place = np.unique(np.stack(rows, 1), return_inverse=True)
    place = place.reshape(bit.shape)
    times = np.repeat(n.astype(np.float64), 8)
    ones = np.bincount(place.ravel(), times * bit.ravel(), len(keys))
    zeros = np.bincount(place.ravel(), times, len(keys)) - ones
    whole = _log_estimate(zeros, ones)
    levels = [(keys, zeros, ones, whole, np.ones(len(keys)), None)]
    for depth in range(DEPTH - 1, CUT - 1, -1):
        keys, up = np.unique(keys & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        zeros, ones, below = (np.bincount(up, x, len(keys)) for x in (zeros, ones, whole))
        own = _log_estimate(zeros, ones)
        whole = np.logaddexp(own, below) - np.log(2)
        levels.append((keys, zeros, ones, whole, np.exp(own - np.log(2) - whole), up))
    return levels, place, bit


def _subtrees(batches, name: str):
    """Whole subtrees of rows sorted by ``name``, many at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        subtree = batch.column(name).to_numpy()
        last = int(np.searchsorted(subtree, subtree[-1])) if len(subtree) else 0
        if held and len(subtree) and held[-1].column(name)[-1].as_py() != subtree[0] and last == 0:
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _own() -> Column:
    """Log of the Krichevsky-Trofimov probability of ``zeros`` and ``ones``."""

    def log_gamma(x: Column) -> Column:  # Stirling's series from x + 8 on, and the steps down
        y, steps = x + 8, x
        for i in range(1, 8):
            steps = steps * (x + i)
        return ((y - 0.5) * F.log(y) - y + 0.5 * float(np.log(2 * np.pi)) + 1 / (12 * y)
                - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - F.log(steps))

    return F.when(F.col("zeros") + F.col("ones") > 0, (
        log_gamma(F.col("zeros") + 0.5) + log_gamma(F.col("ones") + 0.5) - float(np.log(np.pi))
        - log_gamma(F.col("zeros") + F.col("ones") + 1.0))).otherwise(0.0)


def log_probabilities(grams: DataFrame, keep: Keep) -> DataFrame:
    """gram, log: log10 of the probability of each gram's byte after its context.

    Row of a level: a context of that depth with one of the 255 decisions of a byte, as
    ``key``. Decision i is the lowest byte of the key and has the bits of i behind its
    leading 1; the oldest byte of the context is the highest. What lies below a context of
    ``CUT`` bytes is a subtree, which one task weighs and later mixes; above, each depth
    is a ``groupBy`` on the way up and a join on the way down.
    """
    subtree = F.expr(f"shiftright(gram, 8) & {(1 << 8 * CUT) - 1}").alias("subtree")
    dealt = grams.select(subtree, "gram", "n")

    def up(batches):
        for table in _subtrees(batches, "subtree"):
            gram, n = (table.column(c).to_numpy() for c in ("gram", "n"))
            keys, zeros, ones, whole, _, _ = _raised(gram, n)[0][-1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, zeros, ones, whole)],
                                             ["key", "zeros", "ones", "whole"])

    level = keep(dealt.repartition("subtree").sortWithinPartitions("subtree").mapInArrow(
        up, "key bigint, zeros double, ones double, whole double"), f"level-{CUT}")
    log2, levels = float(np.log(2)), [level]
    for depth in range(CUT - 1, -1, -1):
        sums = level.groupBy(F.col("key").bitwiseAND((1 << 8 * (depth + 1)) - 1).alias("key")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("whole").alias("below"))
        own, below = F.col("own"), F.col("below")
        whole = F.greatest(own, below) + F.log1p(F.exp(-F.abs(own - below))) - log2
        level = keep(sums.withColumn("own", _own()).withColumn("whole", whole).select(
            "key", "zeros", "ones", "whole", F.exp(own - log2 - F.col("whole")).alias("share")),
            f"level-{depth}")
        levels.append(level)
    odds = (F.col("zeros") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    above = levels.pop().select("key", (F.col("share") * odds).alias("carried"),
                                (1 - F.col("share")).alias("weight"))
    for depth in range(1, CUT):
        parent = F.col("key").bitwiseAND((1 << 8 * depth) - 1).alias("up")
        above = levels.pop().select(parent, "key", odds.alias("odds"), "share").join(
            above.withColumnRenamed("key", "up"), "up").select(
            "key", (F.col("carried") + F.col("weight") * F.col("share") * F.col("odds")).alias("carried"),
            (F.col("weight") * (1 - F.col("share"))).alias("weight"))
    parent = F.col("key").bitwiseAND((1 << 8 * CUT) - 1).alias("up")
    entry = levels.pop().select(parent, "key").join(above.withColumnRenamed("key", "up"), "up").select(
        F.shiftright("key", 8).alias("subtree"), "key", "carried", "weight")

    def down(batches):
        for table in _subtrees(batches, "subtree"):
            is_gram = table.column("gram").is_valid().to_numpy()
            gram, n = (table.column(c).to_numpy()[is_gram].astype(np.int64) for c in ("gram", "n"))
            key, carried, weight = (table.column(c).to_numpy()[~is_gram]
                                    for c in ("key", "carried", "weight"))
            levels, place, bit = _raised(gram, n)
            order = np.argsort(key)  # the same keys as those of the level at CUT
            carried, weight = carried[order], weight[order]
            for depth in range(CUT, DEPTH + 1):
                _, zeros, ones, _, share, _ = levels[DEPTH - depth]
                if depth > CUT:
                    above = levels[DEPTH - depth + 1][5]
                    carried, weight = carried[above], weight[above]
                carried = carried + weight * share * (zeros + 0.5) / (zeros + ones + 1.0)
                weight = weight * (1 - share)
            zero = np.clip(carried, 1e-12, 1 - 1e-12)
            logs = np.where(bit, np.log10(1 - zero)[place], np.log10(zero)[place]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(logs.astype(np.float32))],
                                             ["gram", "log"])

    return dealt.unionByName(entry, allowMissingColumns=True).repartition("subtree").sortWithinPartitions(
        "subtree").mapInArrow(down, "gram bigint, log float")


@dataclass
class Tree:
    """``child[node, byte]`` is the node of the context one byte longer, 0 if there is none;
    ``logs[node, byte]`` is log10 of the probability of a byte where the context ends there."""

    child: np.ndarray
    logs: np.ndarray

    def score(self, seen: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 of the probability of the byte at each place, from those before it."""
        child, logs = self.child.ravel(), self.logs.ravel()
        out = np.empty(len(at), np.float32)
        for low in range(0, len(at), 1 << 16):  # so that the places stay in the cache
            here = at[low:low + (1 << 16)]
            node = child.take(seen.take(here - 1)).astype(np.int32)
            longest, on = node.copy(), np.flatnonzero(node)
            node = node.take(on)
            for back in range(2, DEPTH + 1):
                step = child.take((node << 8) + seen.take(here.take(on) - back))
                there = np.flatnonzero(step)
                on, node = on.take(there), step.take(there).astype(np.int32)
                longest[on] = node
            out[low:low + (1 << 16)] = logs.take((longest << 8) + seen.take(here))
        return out


def weigh(depth: np.ndarray, context: np.ndarray, byte: np.ndarray, n: np.ndarray) -> Tree:
    """The tree from counts of the byte after each context, in one process.

    The plain form of ``log_probabilities``, against which tests hold it.
    """
    if not len(depth):
        return Tree(np.zeros((1, 256), np.uint16), np.full((1, 256), 8 * np.log10(0.5), np.float32))
    keys = depth.astype(np.int64) << 40 | context
    nodes, row = np.unique(keys, return_inverse=True)
    level, name = nodes >> 40, nodes & ((1 << 40) - 1)
    after = np.zeros((len(nodes), 256))
    np.add.at(after, (row, byte), n)
    # A node's parent has the context without its oldest byte.
    parent = np.full(len(nodes), -1)
    deep = level > 0
    shorter = name & ((1 << 8 * np.maximum(level - 1, 0)) - 1)
    parent[deep] = np.searchsorted(nodes, (level[deep] - 1) << 40 | shorter[deep])
    child = np.zeros((len(nodes), 256), np.uint16 if len(nodes) <= 1 << 16 else np.uint32)
    oldest = name >> (8 * np.maximum(level - 1, 0)) & 255
    child[parent[deep], oldest[deep]] = np.flatnonzero(deep)

    # The 255 decisions of a byte have a tree of contexts each; one after the other, so
    # that only vectors over the nodes are held. Decision i has first the bits of i
    # behind its leading 1.
    levels = [np.flatnonzero(level == d) for d in range(DEPTH + 1)]
    logs = np.zeros((len(nodes), 256), np.float32)
    for i in range(1, 256):
        bits = i.bit_length() - 1
        low, size = (i << (8 - bits)) & 255, 1 << (8 - bits)
        middle, high = low + size // 2, low + size
        zeros, ones = after[:, low:middle].sum(axis=1), after[:, middle:high].sum(axis=1)
        zero = np.clip(_mixed_odds(zeros, ones, parent, levels), 1e-12, 1 - 1e-12)
        logs[:, low:middle] += np.log10(zero)[:, None].astype(np.float32)
        logs[:, middle:high] += np.log10(1 - zero)[:, None].astype(np.float32)
    return Tree(child, logs)


_GAMMAS = np.array([lgamma(i + 0.5) for i in range(1024)])


def _log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""

    def log_gamma(x):  # of x + 1/2: a table, and Stirling's series for large counts
        y = x + 0.5
        series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y)
        return np.where(x < 1024, _GAMMAS[np.minimum(x, 1023).astype(np.int64)], series)

    y = zeros + ones + 1.0
    factorial = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3)
    return (log_gamma(zeros) + log_gamma(ones) - np.log(np.pi)
            - np.where(y < 2, 0.0, factorial))


def _mixed_odds(zeros: np.ndarray, ones: np.ndarray, parent: np.ndarray, levels: list[np.ndarray],
                ) -> np.ndarray:
    """Probability of a zero where the context ends at each node: the mixture over depths."""
    estimate, odds = _log_estimate(zeros, ones), (zeros + 0.5) / (zeros + ones + 1.0)
    # From the deepest level up: the weighted probability of a node, and what its
    # children coded. Counts whose longer context is not kept belong to a leaf of their
    # own, which is coded by the estimate of those counts.
    below, inside, inside_ones = (np.zeros_like(zeros) for _ in range(3))
    share = np.ones_like(estimate)
    for d in range(DEPTH, -1, -1):
        here = levels[d]
        weighted = estimate[here]
        if d < DEPTH:
            rest = _log_estimate(zeros[here] - inside[here], ones[here] - inside_ones[here])
            own = weighted
            weighted = np.logaddexp(own, below[here] + rest) - np.log(2)
            share[here] = np.exp(own - np.log(2) - weighted)
        if d:
            up = parent[here]
            below += np.bincount(up, weighted, len(zeros))
            inside += np.bincount(up, zeros[here], len(zeros))
            inside_ones += np.bincount(up, ones[here], len(zeros))
    # From the root down: the mixture at a node is its own odds and what lies below it.
    # A context that ends at a node for want of a longer one uses the counts left over.
    rest_odds = (zeros - inside + 0.5) / (zeros + ones - inside - inside_ones + 1.0)
    mixed, carried, weight = np.empty_like(odds), np.zeros_like(odds), np.ones_like(odds)
    for d in range(DEPTH + 1):
        here = levels[d]
        if d:
            up = parent[here]
            carried[here] = carried[up] + weight[up] * share[up] * odds[up]
            weight[here] = weight[up] * (1 - share[up])
        last = odds[here] if d == DEPTH else (
            share[here] * odds[here] + (1 - share[here]) * rest_odds[here])
        mixed[here] = carried[here] + weight[here] * last
    return mixed


def word_counts(training: DataFrame, text: str) -> DataFrame:
    """word, n: the count of every token of the training texts but the ends."""

    def count(batches):
        held: Counter = Counter()

        def flush():
            words = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([held[w] for w in words], pa.int64())],
                ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update((text or b"").lower().split())
                if len(held) > HELD_WORDS:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    rows = training.select(F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame) -> DataFrame:
    """The words whose counts go to every task: a bound on their number and on their bytes."""
    return counts.filter(F.octet_length("word") <= SENT_BYTES).orderBy(F.desc("n"), "word").limit(FREQUENT)


def pack_chances(gram: np.ndarray, log: np.ndarray) -> bytes:
    """Sorted grams and their logs: all first bytes, all second bytes and so on, which
    makes them compress well."""
    bytes_of = [x.view(np.uint8).reshape(len(x), -1) for x in
                (np.ascontiguousarray(gram, "<i8"), np.ascontiguousarray(log, "<f4"))]
    return np.concatenate([bytes_of[0][:, :DEPTH + 1], bytes_of[1]], axis=1).T.tobytes()


def unpack_chances(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(raw, np.uint8).reshape(DEPTH + 5, -1).T
    gram = np.zeros((len(rows), 8), np.uint8)
    gram[:, :DEPTH + 1] = rows[:, :DEPTH + 1]
    return gram.view("<i8").ravel(), np.ascontiguousarray(rows[:, DEPTH + 1:]).view("<f4").ravel()


def packed_chances(chances: DataFrame) -> DataFrame:
    """block, and pieces of its (gram, log) rows, compressed, as ``text``."""

    def run(batches):
        pack, held = zstandard.ZstdCompressor(level=1), []

        def flush():
            block, gram, log = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((gram, block))
            block, gram, log = block[order], gram[order], log[order]
            names, pieces = [], []
            for low, high, number in _stretches(block):
                names.append(number)
                pieces.append(pack.compress(pack_chances(gram[low:high], log[low:high])))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(pieces, pa.binary())], ["block", "text"])

        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(c).to_numpy() for c in ("block", "gram", "log")])
            if sum(len(x[0]) for x in held) >= HELD_GRAMS:
                yield flush()
        if held:
            yield flush()

    return chances.select("block", "gram", "log").mapInArrow(run, "block bigint, text binary")


_PARTIAL = ("_row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
            "base double, score double, rare array<struct<word: binary, times: bigint>>")


def score(documents: DataFrame, held_out: Column, keep: Keep, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Scores of every text, from those that are not held out.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"),
                            F.coalesce(held_out, F.lit(False)).alias("held_out"),
                            F.col(text).alias("text"))
    dealt = keep(blocks(rows), "dealt")
    training = dealt.filter(~F.col("held_out"))
    pairs = keep(block_grams(dealt), "pairs")
    grams = keep(pairs.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    logs = keep(log_probabilities(grams, keep), "logs")
    counts = keep(word_counts(training, "text"), "words")
    ends = training.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("word").alias("v")).first()
    tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    whole = float(np.log10(max(tokens + distinct + 1, 1)))
    frequent = frequent_words(counts).toArrow()
    # One string of words and one of logs: small to send, built into a table by each worker.
    table = (b"\n".join(frequent.column("word").to_pylist()),
             np.log10(frequent.column("n").to_numpy() + 1.0).astype(np.float64).tobytes())
    end_log = float(np.log10(ends + 1.0))
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        names, logs = shared.value
        logs = dict(zip(names.split(b"\n"), np.frombuffer(logs).tolist(), strict=True)) if logs else {}
        # The grams of a block come before its texts.
        held, known, block, unpack = [], None, None, zstandard.ZstdDecompressor()
        for batch in batches:
            for low, high, number in _stretches(batch.column("block").to_numpy()):
                if number != block:
                    held, known, block = [], None, number
                stretch = batch.slice(low, high - low)
                first = int(np.count_nonzero(~stretch.column("is_text").to_numpy(zero_copy_only=False)))
                if first:
                    held += [unpack_chances(unpack.decompress(x))
                             for x in stretch.column("text").slice(0, first).to_pylist()]
                if first == high - low:
                    continue
                if known is None:
                    known = GramTable(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held = []
                for at in range(first, high - low, UNPACKED_ROWS):
                    texts = unpacked(stretch.slice(at, UNPACKED_ROWS))
                    for part, data, offsets in parts(texts, "text", PASS_BYTES):
                        yield score_part(part, data, offsets, known, logs)

    def score_part(part, data, offsets, known, logs):
        seen, at, begins = symbols(data, offsets)
        found = known.find(grams_at(seen, at).astype(np.int64))
        lm = np.add.reduceat(found.astype(np.float64), begins[:-1])
        raw = data.tobytes()
        out: list[list] = [[], [], [], []]
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            words = raw[low:high].lower().split()
            found = [logs.get(w) for w in words]
            rare = Counter(w for w, x in zip(words, found, strict=True) if x is None)
            common = [x for x in found if x is not None]
            out[0].append(len(words) + 1)
            out[1].append(len(common) + (ends > 0))
            out[2].append(sum(common) + end_log - (len(words) + 1) * whole)
            out[3].append([{"word": w, "times": t} for w, t in sorted(rare.items())])
        return pa.RecordBatch.from_arrays([
            *(part.column(c) for c in ("_row", "doc_id", "held_out")),
            pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
            pa.array(out[2], pa.float64()), pa.array(lm),
            pa.array(out[3], pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])))],
            ["_row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])

    texts = packed(dealt.withColumn("text", F.coalesce("text", F.lit("")))).withColumn(
        "is_text", F.lit(True))
    chances = packed_chances(pairs.select("block", "gram").join(logs, "gram")).withColumn(
        "is_text", F.lit(False))
    parted = texts.unionByName(chances, allowMissingColumns=True).repartition(
        partitions_for(documents.sparkSession, text_bytes(dealt), BLOCK), "block")
    partial = keep(parted.sortWithinPartitions("block", "is_text").mapInArrow(run, _PARTIAL), "partial")
    rare = partial.select("_row", F.explode("rare").alias("r")).select("_row", "r.*")
    joined = rare.join(counts, "word").select(
        "_row", "times", (F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"))
    known = joined.groupBy("_row").agg(F.sum("times").alias("_known"), F.sum("logs").alias("_logs"))
    return partial.drop("rare").join(known, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_logs", F.lit(0.0))).alias("base_score"), "score")
