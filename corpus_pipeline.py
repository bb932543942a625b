"""A corpus pipeline: quality rules, near duplicates, repeats, leaks, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.llm import bpe, decontamination, near_dedup, quality_rules, suffix_dedup
from seatwise.llm.common import importable, read, store
from seatwise.session import temporary_store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rule and the fences of their language and source. One
    without text has no words and goes; repeated rows share their verdict."""
    with temporary_store(spark) as own:
        judged = quality_rules.judge(docs, measured=own(quality_rules.measure(docs), "measured"))
        verdicts = store(spark)(judged.select("doc_id", "_key", "kept"), "verdicts")
    return quality_rules.accepted(docs, verdicts)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    with temporary_store(spark) as own:
        classes = store(spark)(near_dedup.classes(docs, own), "classes")
    return near_dedup.representatives(docs, classes)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes that an earlier one has; null and very
    long texts included. None goes, also if nothing is left of it."""
    with temporary_store(spark) as own:
        spans = store(spark)(suffix_dedup.repeated_spans(docs, own), "spans")
    return suffix_dedup.removed(docs, spans).withColumn("n_chars", F.length("text").cast("long"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; rows without an id or with a repeated one
    are judged by their own text, and one without text stays."""
    with temporary_store(spark) as own:
        found = decontamination.leaking_texts(docs, read(spark, sf_dir, "benchmark"), own)
        listed = store(spark)(found, "leaks")
    return decontamination.clean_texts(docs, listed)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document left (little-endian unsigned 32-bit integers), and digests that
    show that they decode to its text. A null or empty text has no ids."""
    importable(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.encode(docs, ranks, pattern), ranks, keep_ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("leaks", leaks),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    keep, docs = store(spark), read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs


#: Sketches, suffix ranks and token ids have no equivalent in SQL.
ORACLE_SQL = None
