"""Benchmark decontamination by MinHash containment search, in expressions only.

An item is contained in a document that has at least ``CONTAINMENT`` of its different
shingles of five lower-cased words. A document far longer than an item has a Jaccard
similarity near zero to it, at which bands of whole-document signatures find nothing.
So the sketch is on the item's side: its smallest shingle hashes (bottom-k MinHash),
with k one more than the number of shingles that a match may lack, so that a document
which contains the item has one of them for certain. Items are partitioned by size; a
partition's largest sketch hash bounds the shingles of a document that are looked up
in that partition. Candidates are then verified by all their shingles.

Defined results: a null or empty text has no shingles and matches nothing. A text of one
to four words is one shingle, so an item that short is found in documents of the same
words and no others. Texts of any length are taken whole. Rows with one doc_id are one
document, and rows with one item_id one item; a null id is left out of the leaks, as
nothing could name it. ``clean_texts`` judges every row by its own text, whatever its id.
Empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 5
CONTAINMENT = 0.8

_SHINGLES = """slice(transform(_words, (x, i) -> xxhash64(x, get(_words, i + 1),
    get(_words, i + 2), get(_words, i + 3), get(_words, i + 4))),
    1, greatest(size(_words) - 4, least(size(_words), 1)))"""
_WORDS = "array_remove(split(lower(_text), '[\\\\x20\\\\x09-\\\\x0D]+'), '')"


def shingles(rows: DataFrame, id_column: str, text: str) -> DataFrame:
    """id and ``_shingles``: the hashes of a row's shingles in order, with repeats."""
    return (
        rows.filter(F.col(id_column).isNotNull() & F.col(text).isNotNull())
        .select(F.col(id_column).alias("id"), F.col(text).alias("_text"))
        .select("id", F.expr(_WORDS).alias("_words"))
        .select("id", F.expr(_SHINGLES).alias("_shingles"))
    )


def sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """item_id, size class, and a row per hash of the item's bottom-k sketch.

    ``items`` has item_id and ``h``, a row per different shingle.
    """
    sized = items.groupBy("item_id").agg(F.count("h").alias("_size"),
                                         F.sort_array(F.collect_list("h")).alias("_hashes"))
    k = F.floor(F.col("_size") * (1 - containment) + 1e-9).cast("int") + 1
    return sized.select(
        "item_id", F.floor(F.log2("_size")).cast("int").alias("size_class"),
        F.explode(F.slice("_hashes", F.lit(1), k)).alias("h"))


def leaks(documents: DataFrame, benchmark: DataFrame, keep: Callable[[DataFrame, str], DataFrame],
          doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
          containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles and containment of every contained item.

    ``keep`` writes a DataFrame and reads it back: the candidates are written so that
    the join with the documents goes by their measured size.
    """
    items = keep(
        shingles(benchmark, item_id, text)
        .select(F.col("id").alias("item_id"), F.explode("_shingles").alias("h")).distinct(),
        "items")
    sketched = keep(sketches(items, containment), "sketches")
    bounds = sketched.groupBy("size_class").agg(F.max("h").alias("_bound"))
    # One row: the widest bound of any class. It cuts the arrays before they become rows.
    widest = bounds.agg(F.max("_bound").alias("b")).first()["b"]
    if widest is None:
        return _none(documents, benchmark, doc_id, item_id)
    drawn = shingles(documents, doc_id, text).select(
        "id", F.explode(F.array_distinct(F.filter(
            "_shingles", lambda h: h <= F.lit(widest)))).alias("h"))
    found = drawn.join(sketched, "h")
    candidates = keep(found.groupBy("id").agg(F.count("h").alias("_hits")), "candidates")
    whole = shingles(
        documents.select(F.col(doc_id).alias("id"), F.col(text).alias("_body"))
        .join(candidates.select("id"), "id", "left_semi"), "id", "_body")
    shared = (
        whole.select(F.col("id").alias("doc_id"), F.explode(F.array_distinct("_shingles")).alias("h"))
        .join(items, "h").distinct()
        .groupBy("doc_id", "item_id").agg(F.count("h").alias("n_shared"))
    )
    sizes = items.groupBy("item_id").agg(F.count("h").alias("n_shingles"))
    share = F.col("n_shared") / F.col("n_shingles")
    return shared.join(sizes, "item_id").select(
        "doc_id", "item_id", "n_shared", "n_shingles", share.alias("containment"),
    ).filter(F.col("n_shared") >= F.col("n_shingles") * containment - 1e-9)


def _none(documents: DataFrame, benchmark: DataFrame, doc_id: str, item_id: str) -> DataFrame:
    pairs = documents.select(F.col(doc_id).alias("doc_id")).limit(0).join(
        benchmark.select(F.col(item_id).alias("item_id")).limit(0))
    return pairs.select("doc_id", "item_id", F.lit(0).cast("long").alias("n_shared"),
                        F.lit(0).cast("long").alias("n_shingles"),
                        F.lit(0.0).alias("containment"))


def leaking_texts(documents: DataFrame, benchmark: DataFrame,
                  keep: Callable[[DataFrame, str], DataFrame], item_id: str = "item_id",
                  text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """``leaks`` with a digest of the text in place of the id, as ``doc_id``.

    Rows without an id, and differing texts of one id, are each judged. Copies of a text
    are looked up once.
    """
    texts = documents.filter(F.col(text).isNotNull()).select(
        _text_key(text).alias("_key"), F.col(text).alias(text))
    items = benchmark.select(item_id, text)
    return leaks(texts, items, keep, "_key", item_id, text, containment)


def clean_texts(documents: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """The documents, all columns, whose text is not one of ``leaking_texts``."""
    bad = found.select(F.col("doc_id").alias("_bad")).distinct()
    return documents.join(
        bad, _text_key(text) == F.col("_bad"), "left_anti").select(*documents.columns)


def _text_key(text: str):
    return F.unhex(F.md5(F.col(text).cast("binary")))


def clean(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents, all columns, that contain no item."""
    bad = found.select(F.col("doc_id").alias("_bad")).distinct()
    return documents.join(bad, F.col(doc_id) == F.col("_bad"), "left_anti")
