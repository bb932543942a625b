"""Hard negatives by exact search in a multiway hyperplane tree with distance ranges (GNAT).

Components are scaled to integers, and a score is the integer inner product. One more
component, sqrt(R - |x|^2), gives all rows the same length, and with zero in its place for an
anchor the squared distance is |a|^2 + R - 2 * score: a window of scores is an annulus of
distances.

A node of the tree has up to ``FANOUT`` split points; a row belongs to the child of its
nearest one. For each split point the node stores the least and the largest distance to the
rows below every sibling. A search measures an anchor's distance to the split points and
drops each sibling whose range cannot meet the annulus (``reached``). Leaves are scanned
whole, so results are exact.

Split points come from a bounded sample, the ``SAMPLE`` rows with the smallest hashes; every
row is placed and indexed. Leaves are kept as blocks of about ``BLOCK_ROWS`` packed rows, so a
leaf with any share of the rows (equal vectors cannot be told apart) is many blocks. Anchors
are searched in chunks; a chunk goes to the leaves that some of its anchors reach, with
just those. Each search runs twice: first in the anchor's own leaf, whose k-th score narrows
the window, then in the whole tree. Only the tree and one row of ranges per leaf pass through the
driver; both have as many rows as the sample allows, whatever the table.

Defined results: rows without id, label or vector, or with a component that is null or not
finite, take no part. Rows equal in id, label and vector count once; other rows of one id are
rows of their own, ties among them going by a hash of their content, and an anchor's own id
is never its positive. Vectors of different lengths compare as if filled up with zeros. An empty
table, or one without anchors, gives an empty result. Scores that a long cannot hold fail the
job. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatwise.llm.common import utf8

#: Parameters of the index.
SAMPLE = 4_096
FANOUT = 8
LEAF_ROWS = 1_024
BLOCK_ROWS = 4_096
#: Queries searched together.
CHUNK = 512

_RANGE = np.iinfo(np.int64).max >> 1


@dataclass
class Node:
    """Split points (scaled components and the extra one) and what lies below each."""

    points: np.ndarray
    extra: np.ndarray
    children: list[Node | int]
    #: By child, the places in ``leaves`` below it.
    below: list[list[int]]
    #: Least and largest distance from split point i to the rows below child j.
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)


@dataclass
class Tree:
    root: Node | int
    depth: int
    dim: int
    #: R, the squared length given to all rows.
    length: float
    #: For each leaf the nodes and children passed on the way to it.
    paths: list[list[tuple[Node, int]]]

    def extra(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.length - (vectors ** 2).sum(1), 0.0))


def _distances(a, a_extra, b, b_extra) -> np.ndarray:
    squared = ((a ** 2).sum(1) + a_extra ** 2)[:, None] + (b ** 2).sum(1) + b_extra ** 2
    return np.sqrt(np.maximum(squared - 2 * (a @ b.T + np.outer(a_extra, b_extra)), 0.0))


def grow(sample: np.ndarray, rows: int, length: float, fanout: int = FANOUT,
         leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree over a sample of a table of ``rows`` rows, with leaves of about ``leaf_rows``."""
    tree = Tree(0, 0, sample.shape[1], length, [])
    extra = tree.extra(sample)
    each = rows / max(len(sample), 1)

    def node(members: np.ndarray, path: list) -> Node | int:
        points = _far_apart(sample[members], extra[members], fanout)
        if len(members) * each <= leaf_rows or len(members) < 2 * fanout or len(points) < 2:
            tree.paths.append(path)
            tree.depth = max(tree.depth, len(path))
            return len(tree.paths) - 1
        chosen = members[points]
        made = Node(sample[chosen], extra[chosen], [], [])
        nearest = _distances(
            sample[members], extra[members], made.points, made.extra).argmin(1)
        for child in range(len(chosen)):
            first = len(tree.paths)
            made.children.append(node(members[nearest == child], [*path, (made, child)]))
            made.below.append(list(range(first, len(tree.paths))))
        return made

    tree.root = node(np.arange(len(sample)), [])
    return tree


def _far_apart(points: np.ndarray, extra: np.ndarray, count: int) -> list[int]:
    """Places of up to ``count`` different points, each the farthest from those before it,
    out of the first ten times as many."""
    points, extra = points[:10 * count], extra[:10 * count]
    chosen: list[int] = []
    gap = np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)):
        best = int(gap.argmax())
        if gap[best] <= 1e-6:
            break
        chosen.append(best)
        new = _distances(points, extra, points[best:best + 1], extra[best:best + 1])[:, 0]
        gap = np.minimum(gap, new)
    return chosen


def place(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's leaf, and its distances to the split points of the nodes on its way."""
    leaf = np.zeros(len(vectors), np.int32)
    found = np.full((len(vectors), tree.depth * FANOUT), np.nan)
    extra = tree.extra(vectors)

    def descend(node, members, level):
        if isinstance(node, int):
            leaf[members] = node
            return
        distances = _distances(vectors[members], extra[members], node.points, node.extra)
        at = level * FANOUT
        found[members, at:at + distances.shape[1]] = distances
        nearest = distances.argmin(1)
        for child, below in enumerate(node.children):
            if (part := members[nearest == child]).size:
                descend(below, part, level + 1)

    descend(tree.root, np.arange(len(vectors)), 0)
    return leaf, found


def set_ranges(tree: Tree, leaves: dict[int, tuple[list[float], list[float]]]) -> None:
    """Distance ranges of every node from those of each leaf that has rows."""
    for leaf, (low, high) in leaves.items():
        for level, (node, child) in enumerate(tree.paths[leaf]):
            count = len(node.points)
            if node.low is None:
                node.low = np.full((count, count), np.inf)
                node.high = np.full((count, count), -np.inf)
            at = slice(level * FANOUT, level * FANOUT + count)
            node.low[:, child] = np.minimum(node.low[:, child], low[at])
            node.high[:, child] = np.maximum(node.high[:, child], high[at])


def reached(tree: Tree, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray,
            ) -> list[tuple[int, np.ndarray]]:
    """Leaves that may hold rows between ``inner`` and ``outer`` of each anchor: leaf and
    places of the anchors."""
    found: list[tuple[int, np.ndarray]] = []
    slack = 1e-6 * (1.0 + np.sqrt(tree.length))
    none = np.zeros(len(anchors))

    def descend(node, members):
        if not members.size:
            return
        if isinstance(node, int):
            found.append((node, members))
            return
        if node.low is None:
            return
        to_points = _distances(anchors[members], none[members], node.points, node.extra)
        for child, below in enumerate(node.children):
            low, high = node.low[:, child], node.high[:, child]
            if low[0] > high[0]:
                continue
            nearest = np.maximum(low - to_points, to_points - high).max(1)
            farthest = (to_points + high).min(1)
            alive = (nearest <= outer[members] + slack) & (farthest >= inner[members] - slack)
            descend(below, members[alive])

    descend(tree.root, np.arange(len(anchors)))
    return found


def matrix(packed: pa.Array, dim: int) -> np.ndarray:
    """Packed 32-bit components, one row each, as doubles filled up with zeros."""
    data, offsets = utf8(packed)
    starts = offsets // 4
    values = data.view(np.int32)
    if (np.diff(starts) == dim).all():
        return values.reshape(len(packed), dim).astype(np.float64)
    out = np.zeros((len(packed), dim))
    for i in range(len(packed)):
        out[i, :starts[i + 1] - starts[i]] = values[starts[i]:starts[i + 1]]
    return out


def _scores(queries: np.ndarray, rows: np.ndarray, length: float) -> np.ndarray:
    """Exact inner products: as doubles while they hold every partial sum, else as longs."""
    if length < 2.0 ** 52:
        return queries @ rows.T
    return queries.astype(np.int64) @ rows.astype(np.int64).T


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """By row the places of the k highest allowed scores; on ties the first places."""
    for row in np.flatnonzero(allowed.any(1)):
        places = np.flatnonzero(allowed[row])
        yield row, places[np.argsort(-scores[row, places], kind="stable")[:k]]


class _Known:
    """The best k scores that a task has seen for each query: less is not worth handing on.

    Holds a bounded number of queries; forgetting some only means more rows to merge.
    """

    QUERIES = 50_000

    def __init__(self, k: int):
        self.k, self.scores = k, {}

    def least(self, query) -> int:
        found = self.scores.get(query)
        return -_RANGE if found is None or len(found) < self.k else found[-1]

    def add(self, query, scores: list[int]) -> None:
        if len(self.scores) >= self.QUERIES:
            self.scores.clear()
        merged = sorted(self.scores.get(query, []) + scores, reverse=True)
        self.scores[query] = merged[:self.k]


_QUERY = "q_id bigint, q_tag bigint, q_label bigint, q_vector binary, q_key bigint, q_key_tag bigint, q_key_score bigint, low bigint, high bigint"
_QUERY_NAMES = [part.split()[0] for part in _QUERY.split(", ")]
_HIT = "q_id bigint, q_tag bigint, q_key bigint, q_key_tag bigint, q_key_score bigint, id bigint, tag bigint, score bigint"


@dataclass
class Index:
    """Tree with ranges, and the tables of placed rows and of packed leaf blocks."""

    tree: Tree
    placed: DataFrame
    blocks: DataFrame


def clean(rows: DataFrame, scale: int, vec_id: str, vector: str, label: str | Column) -> DataFrame:
    """id, label, vector (scaled 32-bit components, packed), squared length and tag (a hash of
    the content) of the rows that take part."""
    label = F.col(label) if isinstance(label, str) else label
    taking = rows.select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector")).dropna()

    def pack(batches):
        for batch in batches:
            lists = batch.column("vector")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            sizes = np.diff(offsets)
            # A null component arrives as NaN.
            values = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
            values = np.floor(scale * values.astype(np.float64))
            of_row = np.repeat(np.arange(len(sizes)), sizes)
            whole = np.bincount(of_row, ~np.isfinite(values), len(sizes)) == 0
            kept = whole[of_row]
            values, of_row = values[kept], of_row[kept]
            square = np.bincount(of_row, values ** 2, len(sizes))[whole]
            ends = np.concatenate([[0], np.cumsum(4 * sizes[whole])])
            # Components beyond 32 bits do not get past the check of the lengths in ``build``.
            data = np.clip(values, -2.0 ** 31, 2.0 ** 31 - 1).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(square), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            good = pa.array(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(good), batch.column("label").filter(good),
                 packed.cast(pa.binary()), pa.array(square)], ["id", "label", "vector", "square"])

    return taking.mapInArrow(pack, "id bigint, label bigint, vector binary, square double").withColumn(
        "tag", F.xxhash64("label", "vector"))


def build(rows: DataFrame, store: Callable[..., DataFrame], sample: int = SAMPLE,
          leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> Index | None:
    """The index of the rows of ``clean``; None if there are none."""
    rows = store(rows, "packed")
    count, size, length = rows.agg(
        F.count(F.lit(1)), F.max(F.octet_length("vector")), F.max("square")).first()
    if not count:
        return None
    if length >= 2.0 ** 61:
        raise ValueError("components are too large for scores of 64 bits")
    dim, length = size // 4, length * (1 + 1e-9) + 1.0
    taken = rows.orderBy(F.xxhash64("id", "tag"), "id", "tag").limit(sample).select("vector")
    points = matrix(pa.array([bytes(r.vector) for r in taken.collect()], pa.binary()), dim)
    tree = grow(points, count, length, leaf_rows=leaf_rows)

    def put(batches):
        for batch in batches:
            leaf, _ = place(tree, matrix(batch.column("vector"), dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    placed = store(rows.select("id", "tag", "label", "vector").mapInArrow(
        put, "id bigint, tag bigint, label bigint, vector binary, leaf int"), "placed")
    width = tree.depth * FANOUT

    def measure(batches):
        """Rows of each leaf and their distance ranges, as far as this task sees them."""
        seen: dict[int, list] = {}
        for batch in batches:
            leaf, distances = place(tree, matrix(batch.column("vector"), dim))
            for x in np.unique(leaf):
                part = distances[leaf == x]
                found = seen.setdefault(int(x), [0, part[0], part[0]])
                found[0] += len(part)
                found[1] = np.minimum(found[1], part.min(0))
                found[2] = np.maximum(found[2], part.max(0))
        if seen:
            columns = zip(*seen.values(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), *(pa.array(list(c)) for c in columns)],
                ["leaf", "rows", "low", "high"])

    partial = placed.select("vector").mapInArrow(
        measure, "leaf int, rows bigint, low array<double>, high array<double>")
    found = partial.groupBy("leaf").agg(
        F.sum("rows").alias("rows"),
        F.array(*(F.min(F.get("low", F.lit(i))) for i in range(width))).alias("low"),
        F.array(*(F.max(F.get("high", F.lit(i))) for i in range(width))).alias("high"),
    ).collect()
    set_ranges(tree, {r.leaf: (r.low, r.high) for r in found})

    spread = F.create_map(*(F.lit(int(x)) for r in found
                            for x in (r.leaf, -(-r.rows // block_rows))))
    block = F.pmod(F.xxhash64("id", "tag"), spread[F.col("leaf")])
    gathered = placed.select("leaf", block.alias("block"), "id", "tag", "label", "vector").groupBy(
        "leaf", "block").agg(F.sort_array(
            F.collect_set(F.struct("id", "tag", "label", "vector"))).alias("rows"))
    packed = gathered.select(
        "leaf", "block", *(F.col(f"rows.{c}").alias(c) for c in ("id", "tag", "label", "vector")))
    return Index(tree, placed, store(packed, "blocks"))


def _search(index: Index, queries: DataFrame, k: int, same_label: bool, own_leaf: bool,
            store: Callable[..., DataFrame], name: str) -> DataFrame:
    """The k best rows of each query's window: of the query's label or of others, in the leaf
    the query lies in or in all."""
    tree, length = index.tree, index.tree.length
    dim = tree.dim

    def numbers(batch, column):
        return batch.column(column).to_numpy(zero_copy_only=False)

    def route(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                anchors = matrix(part.column("q_vector"), dim)
                if own_leaf:
                    leaves = place_queries(anchors)
                    routes = [(leaf, np.flatnonzero(leaves == leaf)) for leaf in np.unique(leaves)]
                else:
                    least = (anchors ** 2).sum(1) + length
                    inner, outer = (
                        np.sqrt(np.maximum(least - 2.0 * numbers(part, side).astype(float), 0.0))
                        for side in ("high", "low"))
                    routes = reached(tree, anchors, inner, outer)
                if not routes:
                    continue
                members = pa.array(np.concatenate([m for _, m in routes]))
                ends = pa.array(np.cumsum([0, *(len(m) for _, m in routes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(leaf) for leaf, _ in routes], pa.int32()),
                     *(pa.ListArray.from_arrays(ends, part.column(c).take(members))
                       for c in _QUERY_NAMES)], ["leaf", *_QUERY_NAMES])

    def place_queries(anchors):
        return place(tree, anchors)[0]

    def scan(batches):
        known = _Known(k)
        for batch in batches:
            hits = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in batch.schema.names}
                hits.append(scan_block(row, known))
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in zip(*hits, strict=True)],
                    [part.split()[0] for part in _HIT.split(", ")])

    def scan_block(row, known):
        q = {c: row[c].to_numpy(zero_copy_only=False) for c in _QUERY_NAMES if c != "q_vector"}
        names = list(zip(*(q[c].tolist() for c in ("q_id", "q_tag", "q_key", "q_key_tag")), strict=True))
        low = np.maximum(q["low"], [known.least(query) for query in names])
        anchors, rows = matrix(row["q_vector"], dim), matrix(row["vector"], dim)
        ids, tags, labels = (row[c].to_numpy(zero_copy_only=False) for c in ("id", "tag", "label"))
        asked, places, scores = [], [], []
        step = max(1, (1 << 18) // max(len(ids), 1))
        for start in range(0, len(anchors), step):
            part = slice(start, start + step)
            found = _scores(anchors[part], rows, length)
            allowed = (found >= low[part, None]) & (found <= q["high"][part, None])
            same = labels[None, :] == q["q_label"][part, None]
            allowed &= same & (ids[None, :] != q["q_id"][part, None]) if same_label else ~same
            for at, best in _best(found, allowed, k):
                asked.append(np.full(len(best), start + at))
                places.append(best)
                scores.append(found[at, best].astype(np.int64))
                known.add(names[start + at], scores[-1].tolist())
        if not asked:
            return [np.zeros(0, np.int64)] * 8
        asked, places, scores = map(np.concatenate, (asked, places, scores))
        return [*(q[c][asked] for c in ("q_id", "q_tag", "q_key", "q_key_tag", "q_key_score")),
                ids[places], tags[places], scores]

    routes = queries.select(*_QUERY_NAMES).mapInArrow(
        route, "leaf int, " + ", ".join(
            f"{n} array<{t}>" for n, t in (part.split() for part in _QUERY.split(", "))))
    pairs = store(routes, f"{name}_routes").join(index.blocks.drop("block"), "leaf").drop("leaf")
    hits = pairs.mapInArrow(scan, _HIT)
    best = Window.partitionBy("q_id", "q_tag", "q_key", "q_key_tag", "q_key_score").orderBy(
        F.col("score").desc(), "id", "tag")
    return store(hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), name)


def _narrowed(queries: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """``queries`` whose windows begin at the k-th score found so far, where there are k."""
    by = ["q_id", "q_tag", "q_key", "q_key_tag", "q_key_score"]
    least = hits.filter(F.col("rank") == k).select(*by, F.col("score").alias("_least"))
    return queries.join(least, by, "left").withColumn(
        "low", F.greatest("low", F.coalesce("_least", "low"))).select(*queries.columns)


def mine(rows: DataFrame, is_anchor: Column, store: Callable[..., DataFrame], scale: int = 256,
         low: int = 30, high: int = 90, positives: int = 5, negatives: int = 10,
         vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
         **sizes: int) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label, the ``negatives``
    best rows of other labels that score from ``low`` to ``high`` percent of the positive.

    ``is_anchor`` is a condition on the column ``id``. ``sizes`` are those of ``build``.
    """
    spark = rows.sparkSession
    result = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
              "positive_score bigint, negative_score bigint")
    index = build(clean(rows, scale, vec_id, vector, label), store, **sizes)
    if index is None:
        return spark.createDataFrame([], result)
    none = F.lit(0).cast("long")
    anchors = index.placed.filter(is_anchor).dropDuplicates(["id", "tag"]).select(
        F.col("id").alias("q_id"), F.col("tag").alias("q_tag"), F.col("label").alias("q_label"),
        F.col("vector").alias("q_vector"), none.alias("q_key"), none.alias("q_key_tag"),
        none.alias("q_key_score"), F.lit(-_RANGE).alias("low"), F.lit(_RANGE).alias("high"), "leaf")

    def chunked(queries, name):
        """Queries whose anchors are near each other in the tree share chunks."""
        near = ["leaf", "q_id", "q_tag"]
        return store(queries.repartitionByRange(*near).sortWithinPartitions(*near), name)

    anchors = chunked(anchors, "anchors")

    def both(queries, k, same_label, name):
        near = _search(index, queries, k, same_label, True, store, f"{name}_near")
        return _search(index, _narrowed(queries, near, k), k, same_label, False, store, name)

    found = both(anchors, positives, True, "positives")
    windows = found.select(
        "q_id", "q_tag", F.col("id").alias("q_key"), F.col("tag").alias("q_key_tag"),
        F.col("score").alias("q_key_score"),
        F.ceil(F.lit(low) * F.col("score") / 100).alias("low"),
        F.floor(F.lit(high) * F.col("score") / 100).alias("high"),
    ).filter("low <= high")
    queries = chunked(windows.join(
        anchors.select("q_id", "q_tag", "q_label", "q_vector", "leaf"), ["q_id", "q_tag"]), "windows")
    found = both(queries, negatives, False, "negatives")
    return found.select(
        F.col("q_id").alias("anchor_id"), F.col("q_key").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("q_key_score").alias("positive_score"), F.col("score").alias("negative_score"))
