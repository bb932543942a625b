"""Language identification with string kernels.

The kernel of two texts is the number of n-grams of letters (of 1 to 3, blended) that
both have, over the root of the product of their numbers: presence, not counts. A
bounded sample of labelled texts gives Nystroem landmarks and a one-versus-rest kernel
ridge regression. Texts are scored in batches by two matrix products: presence by
landmarks, kernels by weights. N-grams fall into ``BUCKETS`` buckets by a hash.

Defined results: a null text, a text without a letter, and every text where nothing
could be learnt, has the language ``und`` and the score 0. Equal responses go to the
language first in alphabetical order. Repeated rows are scored one by one; equal texts
in the sample count once. An empty table gives an empty result. Only the named columns
are read, and of them only the text for a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatwise.llm.common import mix

ORDERS = 3
BUCKETS = 1 << 14
#: Bounds of the fit: texts and landmarks of each language, languages.
SAMPLE = 300
LANDMARKS = 32
LANGUAGES = 200
RIDGE = 1e-2
#: Texts scored by one matrix product.
BATCH = 256

UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """By code point: its lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of 0 and 1 per text by bucket, and whether it has a letter."""
    texts = [t or "" for t in texts]
    found = np.zeros((len(texts), BUCKETS), np.float32)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _letters()[points].astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    rolled = np.zeros(len(code), np.uint64)
    for n in range(1, ORDERS + 1):
        if len(code) < n:
            break
        rolled = rolled[:len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1:]
        whole = row[:len(rolled)] == row[n - 1:]
        bucket = mix(rolled + np.uint64(n << 56)) % np.uint64(BUCKETS)
        found[row[:len(rolled)][whole], bucket[whole].astype(np.int64)] = 1
    lettered = np.zeros(len(texts), bool)
    lettered[row[code > 0]] = True
    return found, lettered


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def responses(self, found: np.ndarray) -> np.ndarray:
        marks = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return self.apply(found, marks)

    def apply(self, found: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return kernel(found, marks) @ self.weights


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.outer(a.sum(axis=1), b.sum(axis=1)))
    return (a @ b.T) / np.maximum(size, 1)


def sample(documents: DataFrame, usable: Column, text: str = "text", lang: str = "lang",
           ) -> list[tuple[str, bytes]]:
    """(language, presence bits) of up to ``SAMPLE`` different texts per language.

    The texts with the smallest hashes are taken. What reaches the driver is bounded:
    the hashes, then a fixed number of bits of each sampled text.
    """
    rows = documents.filter(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("_hash"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_hash"))
    picked = (
        rows.select("lang", "_hash").distinct()
        .withColumn("_place", place).filter(F.col("_place") <= SAMPLE)
        .select("lang", "_hash").limit(SAMPLE * LANGUAGES).collect()
    )
    if not picked:
        return []
    wanted = {(r["lang"], r["_hash"]) for r in picked}

    def bits(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                found, lettered = presence(part.column(1).to_pylist())
                packed = np.packbits(found.astype(bool), axis=1)
                yield pa.RecordBatch.from_pydict({
                    "lang": part.column(0).filter(pa.array(lettered)),
                    "_hash": part.column(2).filter(pa.array(lettered)),
                    "bits": pa.array([x.tobytes() for x, ok in zip(packed, lettered, strict=True)
                                      if ok], pa.binary())})

    texts = rows.filter(F.col("_hash").isin([h for _, h in wanted])).dropDuplicates(["lang", "_hash"])
    found = texts.mapInArrow(bits, "lang string, _hash bigint, bits binary").collect()
    return [(r["lang"], r["bits"]) for r in
            sorted(found, key=lambda r: (r["lang"], r["_hash"])) if (r["lang"], r["_hash"]) in wanted]


def fit(rows: list[tuple[str, bytes]]) -> Model | None:
    """Landmarks, and the ridge regression in the space that they span."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    packed = np.array([np.frombuffer(b, np.uint8) for _, b in rows])
    found = np.unpackbits(packed, axis=1).astype(np.float32)
    target = np.array([[lang == x for x in languages] for lang, _ in rows], float)
    marks = np.concatenate([np.flatnonzero(target[:, i])[:LANDMARKS] for i in range(len(languages))])
    values, vectors = np.linalg.eigh(kernel(found[marks], found[marks]).astype(float))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    space = kernel(found, found[marks]) @ root
    # Each language weighs the same, however many texts it has.
    weight = 1 / target.sum(axis=0)[target.argmax(axis=1)]
    gram = (space * weight[:, None]).T @ space + RIDGE * len(languages) / len(rows) * np.eye(good.sum())
    solved = np.linalg.solve(gram, (space * weight[:, None]).T @ target)
    return Model(languages, packed[marks], (root @ solved).astype(np.float32))


def predict(documents: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text",
            *others: Column) -> DataFrame:
    """doc_id, the other columns asked for, lang_pred and score of every text."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), *others, F.col(text).alias("_text"))
    kept = rows.drop("_text")

    def score(batches):
        marks = None
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                langs, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                if model is not None:
                    if marks is None:
                        marks = np.unpackbits(model.landmarks, axis=1).astype(np.float32)
                    found, lettered = presence(part.column(part.num_columns - 1).to_pylist())
                    response = model.apply(found, marks)
                    best = response.argmax(axis=1)
                    top = np.clip(response[np.arange(len(best)), best], 0, 1)
                    langs = [model.languages[b] if ok else UNKNOWN
                             for b, ok in zip(best, lettered, strict=True)]
                    scores = np.where(lettered, top, 0).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores)],
                    [*part.schema.names[:-1], "lang_pred", "score"])

    schema = kept.schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(score, schema)
