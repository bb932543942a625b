"""Operators on documents against brute force, on odd tables and on the given ones."""

import random
import time
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import odd
import public_tokenizers as tokens
import pytest
from pyspark.sql import functions as F

from seatwise.llm import (
    bpe,
    common,
    ctw,
    decontamination,
    language_id,
    near_dedup,
    quality_rules,
    queries,
    suffix_dedup,
    token_index,
)
from seatwise.llm.common import held_back, store

FOLDER = "/root/testdata/sf0.001"
RANKS = tokens.path("byte_bpe_50k.tiktoken")


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def oddities(spark):
    rows = odd.documents()
    return rows, odd.frame(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return odd.frame(spark, [])


BPE = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def encoded(frame, **options):
    return bpe.digests(bpe.encode(frame, RANKS, tokens.PATTERN, **options), RANKS)


def test_bpe(spark, given, oddities, empty):
    assert rows_of(queries.op4_byte_bpe(spark, FOLDER), *BPE) == ordered(brute.bpe(given))
    rows, frame = oddities
    assert rows_of(encoded(frame), *BPE) == ordered(brute.bpe(rows))
    assert rows_of(encoded(empty), *BPE) == []
    decoded = bpe.decode(bpe.encode(frame, RANKS, tokens.PATTERN, chunk=64, overlap=16), RANKS)
    assert rows_of(decoded.withColumn("decoded", F.col("decoded").cast("string")),
                   "doc_id", "decoded") == ordered((d, t or "") for d, t in rows)


@pytest.mark.parametrize(("chunk", "overlap"), [(50, 20), (7, 3), (40, 1), (5, 5)])
def test_bpe_chunks_are_stitched(oddities, chunk, overlap):
    """Short overlaps also leave neighbours without a common place."""
    rows, frame = oddities
    found = rows_of(encoded(frame.filter(F.length("text") < 2000), chunk=chunk, overlap=overlap), *BPE)
    assert found == ordered(brute.bpe([r for r in rows if r[1] is not None and len(r[1]) < 2000]))


@pytest.mark.parametrize(("chunk", "overlap"), [(5, 5), (9, 6), (20, 12), (50, 20)])
def test_bpe_of_chunks_that_end_in_white_space(spark, chunk, overlap):
    """A run of white space matches otherwise at the end of a text than before a word."""
    rng = random.Random(chunk)
    marks = [" ", " ", "\n", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "a", "Bc", "é", "12", "!", "'s"]
    rows = [(i, "".join(rng.choice(marks) for _ in range(rng.randint(chunk, 6 * chunk))))
            for i in range(12_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert rows_of(encoded(frame, chunk=chunk, overlap=overlap), *BPE) == ordered(brute.bpe(rows))


def test_bpe_of_blank_lines_at_the_edge_of_a_chunk(spark):
    before, behind = "word " * 20_000, "Then more text. " * 3_000
    rows = [(10 * n + k, before[:bpe.CHUNK + k - 6 - n] + "\n" * n + behind)
            for n in (1, 2, 3, 4) for k in range(8)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert rows_of(encoded(frame), *BPE) == ordered(brute.bpe(rows))


SUFFIX = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def removed(frame, least=50):
    spans = suffix_dedup.repeated_spans(frame, store(frame.sparkSession), least=least)
    return suffix_dedup.digests(frame, spans)


def test_suffix_dedup(spark, given, oddities, empty):
    documents = spark.createDataFrame(given, "doc_id bigint, text string").repartition(11)
    assert rows_of(removed(documents), *SUFFIX) == ordered(brute.suffix(given))
    rows, frame = oddities
    rows = [*rows, (None, rows[0][1]), (None, None)]
    frame = odd.frame(frame.sparkSession, rows)
    for least in (50, 33):
        assert rows_of(removed(frame, least), *SUFFIX) == ordered(brute.suffix(rows, least))
    assert rows_of(removed(empty), *SUFFIX) == []


def test_suffix_dedup_on_random_bytes(spark):
    """Two letters: anchors tie and repeat within a document."""
    rng = np.random.default_rng(5)
    rows = [(i, "".join(rng.choice(list("ab"), 150 + i % 60, p=[0.95, 0.05]))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert rows_of(removed(frame), *SUFFIX) == ordered(brute.suffix(rows))


def test_near_duplicates_shuffles_texts_of_candidates_only(spark):
    """Texts that share no bucket are left out before the exact join, which moves its rows."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["w%d" % j for j in range(500)], k=40))) for i in range(60)]
    rows += [(100, rows[0][1] + " end"), (101, rows[1][1])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    keep, plans = store(spark), {}

    def watched(kept, name):
        plans[name] = kept._jdf.queryExecution().optimizedPlan().toString()
        return keep(kept, name)

    found = {r.doc_id: r.class_id for r in near_dedup.classes(frame, watched).collect()}
    assert found == {i: i for i in range(60)} | {100: 0, 101: 1}
    assert all("_filter_bits" in plans[name] for name in ("shingles", "sketches"))


def test_words_are_encoded_without_offsets():
    """The slower call, which also finds where each token stands, is not made."""
    path = tokens.path("word_bpe_49k.json")
    words = token_index.WordIds(path, np.uint16)
    plain = words.tokenizer
    texts = ["Some words, and (more) words!", "x1 \u0130. \u0130, ...", "", "end."]

    class Fast:
        encode_batch_fast = plain.encode_batch_fast

    words.tokenizer = Fast()
    wanted = [np.array(plain.encode(t, add_special_tokens=False).ids, np.uint16).tobytes() for t in texts]
    assert words.encode(texts) == wanted


def test_encoding_does_not_go_through_the_table_of_words():
    """A text costs a look-up a word, however many words the worker's table holds."""
    class Closed(token_index.WordIds):
        def __iter__(self):
            raise AssertionError("went through the table")

    path = tokens.path("word_bpe_49k.json")
    words, plain = Closed(path, np.uint16), token_index.WordIds(path, np.uint16).tokenizer
    for texts in (["new words, here", "", "here. new"], ["words here and new ones", "ones, ones!"]):
        wanted = [np.array(plain.encode(t, add_special_tokens=False).ids, np.uint16).tobytes() for t in texts]
        assert words.encode(texts) == wanted


def test_lm_chances_move_in_few_bytes(spark):
    """The grams of a block and their logs, in pieces of less than 8 bytes a gram."""
    rng = np.random.default_rng(9)
    gram = np.unique(rng.choice(np.frombuffer(b"etaoin shrdlu", np.uint8), (40_000, 6)).astype(np.int64)
                     @ (1 << 8 * np.arange(6)))
    log = np.log10(rng.random(len(gram))).astype(np.float32)
    back = ctw.unpack_chances(ctw.pack_chances(gram, log))
    assert (back[0] == gram).all() and (back[1] == log).all()
    rows = [(b, int(g), float(x)) for b in (3, 1 << 40) for g, x in zip(gram, log, strict=True)]
    frame = spark.createDataFrame(rows, "block bigint, gram bigint, log float").coalesce(2)
    pieces = ctw.packed_chances(frame).collect()
    assert {r.block for r in pieces} == {3, 1 << 40}
    assert sum(len(r.text) for r in pieces) < 8 * len(rows)


def test_suffix_dedup_hashes_a_block_in_little_memory():
    """A worker's arrays stay far below a hundred times the block of text."""
    rng = np.random.default_rng(6)
    lengths = rng.integers(0, 4_000, 1_000)
    offsets = np.append(0, np.cumsum(lengths))
    data = rng.integers(97, 101, offsets[-1]).astype(np.uint8)
    suffix_dedup.block_runs(data[:offsets[300]], offsets[:301], 50)  # tables kept by the worker
    tracemalloc.start()
    found = suffix_dedup.block_runs(data, offsets, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * len(data)
    whole = suffix_dedup.runs(data, offsets, 50)
    for name, column in whole.items():
        assert (found[name] == column).all() if name != "place" else len(found[name]) == len(column)


def test_signing_takes_little_memory():
    """A worker's arrays stay small however large the batch is."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 9_999, 400)) for _ in range(1_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_000)), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    rows = sum(part.num_rows for part in near_dedup.signed_parts(batch))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1_000 and peak < 20_000_000


def test_removed_texts_keep_whole_characters(oddities):
    rows, frame = oddities
    left = suffix_dedup.removed(frame, suffix_dedup.repeated_spans(frame, store(frame.sparkSession)))
    assert left.columns == frame.columns and left.count() == len(rows)
    wanted = {d: n for d, _, n, _, _ in brute.suffix(rows)}
    sizes = {d: len((t or "").encode()) for d, t in rows}
    for row in left.collect():
        if sizes[row.doc_id] == 0:
            assert not row.text
        else:
            assert 0 <= len(row.text.encode()) - (sizes[row.doc_id] - wanted[row.doc_id]) < 12 * 4


def test_near_duplicates(spark, given, oddities, empty):
    def found(frame):
        return dict(rows_of(near_dedup.classes(frame, store(spark)), "doc_id", "class_id"))

    documents = spark.createDataFrame(given, "doc_id bigint, text string").repartition(6)
    assert found(documents) == brute.classes(given)
    rows, frame = oddities
    assert found(frame) == brute.classes(list(dict(rows).items()))
    assert found(empty) == {}
    nameless = odd.frame(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f")])
    assert rows_of(near_dedup.classes(nameless, store(spark)), "doc_id", "class_id") == ordered(
        [(None, None), (None, None), (1, 1)])
    kept = near_dedup.representatives(nameless, near_dedup.classes(nameless, store(spark)))
    assert kept.count() == 3 and kept.columns == nameless.columns


def test_near_copies_chain_into_one_class(spark):
    """Each text differs from the next by one word, the first and last by many."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        words[(i * 37) % 120] = f"new{i}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = dict(rows_of(near_dedup.classes(frame, store(spark)), "doc_id", "class_id"))
    assert found == brute.classes(rows) and set(found.values()) == {0}


def near_family(n, seed):
    """Texts with one to six of 150 words replaced, each by a word of its own."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_a_large_family_makes_few_pairs(spark):
    """Texts that share too little with all others are not paired, and no link is lost."""
    rows, keep, made = near_family(300, 4), store(spark), {}

    def watched(kept, name):
        made[name] = keep(kept, name)
        return made[name]

    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in near_dedup.classes(frame, watched).collect()}
    assert found == brute.classes(rows)
    assert sum(made[n].count() for n in made if n.startswith("open") and n.endswith("-likely")) < 6_000


def test_small_tables_take_few_files(spark):
    """However many tasks make the tables of ids between the steps."""
    rows, keep, files = near_family(300, 4), store(spark), {}

    def watched(kept, name):
        made = keep(kept, name)
        files[name] = len(made.inputFiles())
        return made

    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        found = {r.doc_id: r.class_id for r in near_dedup.classes(frame, watched).collect()}
    finally:
        spark.conf.unset(merging)
    assert found == brute.classes(rows)
    large = {"signed", "members", "candidates", "shingles", "sketches"}
    assert {"copies", "labels", "open", "open1-likely"} <= files.keys()
    assert max(n for name, n in files.items() if name not in large) <= 4


def test_folds_lose_no_similar_pair():
    rng, texts = random.Random(6), [t for _, t in near_family(120, 9)]
    texts += [" ".join(rng.choices("ab", k=k)) for k in (3000, 3000, 2900)] + ["a " * 5000] * 2 + ["x y"]
    data = pa.array(texts, pa.large_string())
    row, element, weight = near_dedup.weighted_shingles(*common.utf8(data))
    folds = near_dedup.folded(row, element, weight, len(texts))
    counts = [dict(zip(element[row == i].tolist(), weight[row == i].tolist(), strict=True)) for i in range(len(texts))]
    left = lost = far = 0
    for i in range(len(texts)):
        for j in range(i):
            low = sum(min(n, counts[j].get(x, 0)) for x, n in counts[i].items())
            similar = low / (sum(counts[i].values()) + sum(counts[j].values()) - low) >= 0.8
            may = near_dedup.may_be_similar(folds[i:i + 1], folds[j:j + 1], 0.8)[0]
            lost += similar and not may
            far += not similar
            left += may and not similar
    assert lost == 0
    assert left < far / 4


def test_few_files_grow_with_the_rows(spark):
    asked = []
    near_dedup.in_few_files(lambda rows, _: asked.append(rows.rdd.getNumPartitions()), 2_000_001)(
        spark.range(20), "x")
    assert asked == [9]


def test_a_pair_of_many_buckets_is_made_once(spark):
    rows = [(bucket, doc, doc, 100, 100) for bucket in (5, -3, 9) for doc in range(6)]
    rows += [(11, 0, 0, 100, 100), (11, 7, 7, 100, 95), (9, 8, 8, 100, 60), (9, 9, 9, 70, 70)]
    held = spark.createDataFrame(
        rows, "bucket bigint, doc_id bigint, label bigint, total bigint, shared bigint").repartition(3)
    sketches = spark.range(10).select(F.col("id").alias("doc_id"), F.encode(F.lit("s"), "utf-8").alias("sketch"))
    wanted = sorted([(a, b) for b in range(6) for a in range(b)] + [(0, 7)])
    found = near_dedup.open_pairs(held, sketches, 1, 0.8)
    assert sorted((r.u, r.v) for r in found.collect()) == wanted
    # Of a share of the texts: pairs with one of them, still once each.
    some = {r.id for r in spark.range(10).filter(F.pmod(F.xxhash64("id"), F.lit(2)) == 0).collect()}
    found = near_dedup.open_pairs(held, sketches, 2, 0.8)
    assert sorted((r.u, r.v) for r in found.collect()) == [p for p in wanted if some & set(p)]


def test_a_hot_bucket_is_split(spark):
    """A third of all rows in one bucket of several labels."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
             "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key, None) for key in small}
    row = F.col("id")
    members = spark.range(0, 60_000, numPartitions=12).select(
        F.when(row % 3 == 0, 0).otherwise(row % 5_000 + 1).alias("bucket"), row.alias("doc_id"),
        F.when(row % 3 == 0, row % 7).otherwise(0).alias("label"), F.xxhash64("id").alias("total"))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        found = near_dedup._in_open_buckets(members)
        assert {tuple(r)[:2] for r in found.collect()} == {(0, i) for i in range(0, 60_000, 3)}
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_prob_minhash_estimates_probability_jaccard():
    a = {i: i % 4 + 1 for i in range(300)}
    b = {i: (i % 3 + 1) for i in range(60, 360)}
    text = np.repeat([0, 1], [len(a), len(b)])
    element = np.array([*a, *b], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weight = np.array([*a.values(), *b.values()])
    wanted = sum(1 / sum(max(a.get(k, 0) / a[d], b.get(k, 0) / b[d]) for k in {*a, *b})
                 for d in a.keys() & b.keys())
    seen = []
    for turn in range(60):
        signed = near_dedup.signatures(text, element + np.uint64(turn), weight, 2)
        seen.append((signed[0] == signed[1]).mean())
    assert abs(np.mean(seen) - wanted) < 0.03


LEAKS = ("doc_id", "item_id", "n_shared", "n_shingles")


def test_decontamination(spark, given, oddities, empty):
    def found(documents, items):
        return set(rows_of(decontamination.leaks(documents, items, store(spark)), *LEAKS))

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet")
             .select("item_id", "text").collect()]
    rows, frame = oddities
    rng = np.random.default_rng(1)
    planted = list(rows)
    for i, (_, text) in enumerate(items[:10]):  # whole, cut, and with a word changed
        words = text.split()
        words = words[:len(words) - i] if i < 5 else [*words[:8], "other", *words[9:]]
        host = rows[int(rng.integers(len(rows)))][1] or ""
        planted.append((100 + i, host + "\n" + " ".join(words).upper() + "\n" + host))
    table = [*items, (900, None), (901, ""), (902, "one two"), (None, items[0][1]),
             (903, items[3][1]), (3, items[3][1])]
    benchmark = odd.frame(spark, table, "item_id bigint, text string")
    wanted = brute.leaks(planted, table)
    assert len(wanted) > 6
    documents = odd.frame(spark, [*planted, (None, items[0][1])])
    assert found(documents, benchmark) == wanted
    assert found(empty, benchmark) == set()
    assert found(documents, odd.frame(spark, [], "item_id bigint, text string")) == set()
    bad = decontamination.leaks(documents, benchmark, store(spark))
    left = decontamination.clean(documents, bad)
    assert {r.doc_id for r in left.collect()} == (
        {d for d, _ in planted} | {None}) - {d for d, *_ in wanted}
    assert left.columns == documents.columns


def test_texts_are_judged_whatever_their_id(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, f"x {item} y"), (None, "quite another text of more than five words"),
            (1, f"{item} z"), (1, "not an item but of the same id"), (2, None), (3, ""),
            (None, None), (4, "Yes  no"), (5, "yes no maybe"), (6, "well yes no"), (7, "yes")]
    items = odd.frame(spark, [(1, item), (2, "yes NO"), (3, ""), (4, None)],
                      "item_id bigint, text string")
    documents = odd.frame(spark, rows)
    found = decontamination.leaking_texts(documents, items, store(spark))
    left = decontamination.clean_texts(documents, found)
    assert left.columns == documents.columns
    kept = [r for r in rows if r not in (rows[0], rows[2], rows[7])]
    assert ordered((r.doc_id, r.text) for r in left.collect()) == ordered(kept)
    # short items are found in documents of the same words only
    assert rows_of(decontamination.leaks(documents, items, store(spark)), "doc_id", "item_id") == [
        (1, 1), (4, 2)]
    none = decontamination.leaking_texts(documents.limit(0), items, store(spark))
    assert none.isEmpty() and decontamination.clean_texts(documents, none).count() == len(rows)


QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed")


def test_quality_rules(spark, given, oddities, empty):
    assert rows_of(queries.op9_quality_rules(spark, FOLDER), *QUALITY) == ordered(brute.quality(given))
    rows, frame = oddities
    rows = [*rows, (None, None), (None, "w " * 70)]
    frame = odd.frame(spark, rows, lang=None)
    assert rows_of(quality_rules.judge(frame), *QUALITY) == ordered(brute.quality(rows))
    assert quality_rules.judge(empty).isEmpty()
    judged = quality_rules.judge(frame)
    kept = quality_rules.accepted(frame, judged)
    assert kept.columns == frame.columns and kept.count() == judged.filter("kept").count() > 0


def test_quality_verdicts_by_the_definition(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "text", "lang", "source").collect()]
    found = rows_of(queries.op9_quality_rules(spark, FOLDER), "doc_id", "kept")
    assert found == ordered(brute.verdicts(given))
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["#a", "BIG", "small", "x" * rng.randint(1, 30)]) + str(
        rng.randint(0, 90)) for _ in range(rng.randint(40, 90))), rng.choice(["en", "de", None]),
        rng.choice(["s", "t", None])) for i in range(300)]
    rows += [(500 + i, "#$ " * 20 + given[i][1], "fr", "one") for i in range(3)]
    rows += [(600, None, None, None), (601, "", "en", "s")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    assert rows_of(quality_rules.judge(frame.repartition(4)), "doc_id", "kept") == ordered(
        brute.verdicts(rows))


def test_a_filter_on_verdicts_does_not_measure_anew(spark):
    """The windows of a text must not be computed again for each of its words."""
    rows = [(0, " ".join(f"w{i % 997} v{i % 1009}" for i in range(10_000)))]
    start = time.monotonic()
    assert quality_rules.judge(odd.frame(spark, rows)).filter("kept").count() <= 1
    assert time.monotonic() - start < 20


def test_quality_thresholds_adapt_to_the_group(spark):
    """A share of symbols that is usual in one source and far out in another."""
    plain = " ".join(f"word{i}" for i in range(80))
    marked = plain.replace(" word1", " #word1").replace("word2", "*word2*")
    rows = [(i, marked if i < 200 else plain, "s1" if i < 200 else "s2") for i in range(400)]
    rows += [(400, marked, "s2"), (401, marked, "s1"), (402, plain, "s1")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn(
        "lang", F.lit("en"))
    rejected = {r.doc_id for r in quality_rules.judge(frame).filter("not kept").collect()}
    assert rejected == {400}


def test_quality_keeps_good_documents_and_drops_junk(spark):
    folder = "/root/testdata/sf0.1"
    judged = queries.op9_quality_rules(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = {(r.quality, r.kept): r["count"] for r in judged.filter("not base_failed").join(
        labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) <= 0.002 * found[1, True]
    assert found.get((0, True), 0) <= 0.2 * found[0, False]


LM = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")


def scored(frame, folds=7):
    return ctw.score(frame, held_back("doc_id", folds), store(frame.sparkSession))


def test_lm_base_scores(spark, given, oddities, empty):
    documents = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    for rows, frame in ((given, documents), oddities):
        wanted = brute.base_scores(rows)
        found = scored(frame)
        assert rows_of(found, *LM) == ordered(r[:5] for r in wanted)
        assert np.allclose([r[1] for r in rows_of(found, "doc_id", "base_score")],
                           [b for _, b in ordered((r[0], r[5]) for r in wanted)])
    assert scored(empty).isEmpty()
    untrained = odd.frame(spark, [(d, t) for d, t in oddities[0] if brute.held(d, 7)])
    for row in scored(untrained).join(untrained, "doc_id").collect():
        size = len((row["text"] or "").encode())
        assert row.base_score == 0 and np.isclose(row.score, (size + 1) * 8 * np.log10(0.5))


def test_lm_gram_table_finds_every_gram_and_no_other():
    draw = np.random.default_rng(5)
    grams = draw.integers(0, 1 << 48, 50_000)
    logs = (grams % 1009).astype(np.float32)
    twice = draw.integers(0, len(grams), 1_000)  # a block that two tasks read has some twice
    table = ctw.GramTable(np.append(grams, grams[twice]), np.append(logs, logs[twice]))
    asked = draw.permutation(grams)
    assert (table.find(asked) == asked % 1009).all()
    assert len(table.find(asked[:0])) == 0
    with pytest.raises(KeyError):
        table.find(np.append(asked, 1 << 50))
    one = ctw.GramTable(np.array([0]), np.array([-2.5], np.float32))
    assert one.find(np.array([0, 0])).tolist() == [-2.5, -2.5]


def test_lm_grams_are_the_bytes_before_each_place():
    data = np.frombuffer(b"Abcdefgh", np.uint8)
    seen, at, begins = ctw.symbols(data, np.array([0, 3, 3, 8]))
    wanted = []
    for text in (b"abc", b"", b"defgh"):
        padded = bytes([ctw.END]) * ctw.DEPTH + text + bytes([ctw.END])
        wanted += [int.from_bytes(padded[i:i + ctw.DEPTH + 1], "big") for i in range(len(text) + 1)]
    assert ctw.grams_at(seen, at).tolist() == wanted and begins.tolist() == [0, 4, 5, 11]


def test_lm_rare_words_are_joined(spark, given, monkeypatch):
    monkeypatch.setattr(ctw, "FREQUENT", 20)
    frame = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    found = scored(frame)
    wanted = brute.base_scores(given)
    assert rows_of(found, *LM) == ordered(r[:5] for r in wanted)
    assert np.allclose([r[1] for r in rows_of(found, "doc_id", "base_score")],
                       [b for _, b in ordered((r[0], r[5]) for r in wanted)])


def test_lm_long_words_are_not_sent_to_tasks(spark):
    rows = [(i, f"{'x' * 100_000} {'é' * 32} {'y' * 65} a b") for i in range(12)]
    frame = odd.frame(spark, rows)
    sent = ctw.frequent_words(ctw.word_counts(frame, "text")).collect()
    assert {bytes(r.word) for r in sent} == {b"a", b"b", "é".encode() * 32}
    wanted = brute.base_scores(rows)
    found = scored(frame)
    assert rows_of(found, *LM) == ordered(r[:5] for r in wanted)
    assert np.allclose([r[1] for r in rows_of(found, "doc_id", "base_score")],
                       [b for _, b in ordered((r[0], r[5]) for r in wanted)])


def test_context_tree_is_a_weighted_mixture():
    """Against the recursion over a whole tree, of depth 2, on a short text."""
    from fractions import Fraction
    from functools import cache

    text = b"abracadabra abracadabra"
    seen = b"\xff\xff" + text + b"\xff"
    places = range(2, len(seen))

    @cache
    def counts(context, prefix, bits):
        found = [0, 0]
        for at in places:
            if seen[at - len(context):at] == context and seen[at] >> (8 - bits) == prefix:
                found[seen[at] >> (7 - bits) & 1] += 1
        return tuple(found)

    @cache
    def estimate(pair):
        product = Fraction(1)
        for i in range(pair[0]):
            product *= Fraction(2 * i + 1, 2)
        for i in range(pair[1]):
            product *= Fraction(2 * i + 1, 2)
        for i in range(1, sum(pair) + 1):
            product /= i
        return product

    @cache
    def weighted(context, prefix, bits):
        own = estimate(counts(context, prefix, bits))
        if len(context) == 2:
            return own
        below = Fraction(1)
        for byte in set(seen):
            below *= weighted(bytes([byte]) + context, prefix, bits)
        return (own + below) / 2

    def odds(context, prefix, bits, bit):
        pair = counts(context, prefix, bits)
        return Fraction(2 * pair[bit] + 1, 2 * sum(pair) + 2)

    def mixture(history, depth, prefix, bits, bit):
        context = history[len(history) - depth:]
        if depth == 2:
            return odds(context, prefix, bits, bit)
        share = estimate(counts(context, prefix, bits)) / 2 / weighted(context, prefix, bits)
        return share * odds(context, prefix, bits, bit) + (1 - share) * mixture(
            history, depth + 1, prefix, bits, bit)

    wanted = 0.0
    for at in places:
        for bits in range(8):
            bit = seen[at] >> (7 - bits) & 1
            wanted += float(np.log10(float(mixture(seen[at - 2:at], 0, seen[at] >> (8 - bits), bits, bit))))

    depth, nodes = ctw.DEPTH, []
    ctw.DEPTH = 2
    try:
        for d in range(3):
            for at in places:
                context = int.from_bytes(seen[at - d:at], "big")
                nodes.append((d, context, seen[at]))
        keys = sorted(set(nodes))
        columns = np.array(keys).T
        tree = ctw.weigh(*columns, np.array([nodes.count(k) for k in keys]))
        data = np.frombuffer(text, np.uint8)
        symbols, at, _ = ctw.symbols(data, np.array([0, len(data)]))
        found = tree.score(symbols, at).sum()
    finally:
        ctw.DEPTH = depth
    assert np.isclose(found, wanted, rtol=1e-5)


def test_context_tree_is_whole(spark):
    """More contexts than fit a fixed size; texts held out have contexts never seen."""
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz .,", np.uint8)
    rows = [(i, rng.choice(letters, 400).tobytes().decode()) for i in range(80)]
    rows += [(100, None), (101, ""), (None, rows[0][1]), rows[1]]
    nodes = {}
    for doc_id, text in rows:
        if doc_id is None or not brute.held(doc_id, 7):
            seen = b"\xff" * ctw.DEPTH + (text or "").encode() + b"\xff"
            for at in range(ctw.DEPTH, len(seen)):
                for d in range(ctw.DEPTH + 1):
                    key = (d, int.from_bytes(seen[at - d:at], "big"), seen[at])
                    nodes[key] = nodes.get(key, 0) + 1
    assert len({k[:2] for k in nodes}) > 1 << 15
    tree = ctw.weigh(*np.array(list(nodes)).T, np.array(list(nodes.values())))
    wanted = []
    for doc_id, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        seen, at, _ = ctw.symbols(data, np.array([0, len(data)]))
        wanted.append((doc_id, float(tree.score(seen, at).astype(float).sum())))
    found = rows_of(scored(odd.frame(spark, rows)), "doc_id", "score")
    assert [d for d, _ in found] == [d for d, _ in ordered(wanted)]
    assert np.allclose([x for _, x in found], [x for _, x in ordered(wanted)], rtol=1e-5)


def test_lm_gives_probabilities_and_learns(spark):
    found = queries.op8_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    rows = found.select("score", F.octet_length("text").alias("n")).collect()
    bits = -sum(r.score for r in rows) / sum(r.n + 1 for r in rows) * np.log2(10)
    assert bits < 2.9  # a uniform byte has 8


def test_language_id(spark, oddities, empty):
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    assert all(r.held_out == brute.held(r.doc_id, 4) for r in found)
    tested = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in tested]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)
    rows, frame = oddities
    rows = [*rows, (None, None)]
    frame = odd.frame(spark, rows)
    model = language_id.fit(language_id.sample(frame, F.lit(True)))
    guesses = language_id.predict(frame, model)
    assert guesses.count() == len(rows)
    for row in guesses.collect():
        text = dict(rows)[row.doc_id] or ""
        assert row.lang_pred == ("en" if any(c.isalpha() for c in text) else "und")
    assert language_id.predict(empty, model).isEmpty()
    assert language_id.sample(empty, F.lit(True)) == [] and language_id.fit([]) is None
    nothing = language_id.predict(frame, None)
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_presence_kernel():
    texts = ["Abc abd", "abc", "xyz 12", "", None]
    found, lettered = language_id.presence(texts)

    def grams(text):
        text = "".join(c.lower() if c.isalpha() else "\0" for c in text or "")
        return {text[i:i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    assert list(lettered) == [True, True, True, False, False]
    assert found.sum(axis=1).tolist() == [len(grams(t)) for t in texts]
    assert (found @ found.T)[0, 1] == len(grams(texts[0]) & grams(texts[1]))


INDEX = ("doc_id", "start", "n_tokens", "ids_crc32")


def indexed(spark, frame, folder):
    path = tokens.path("word_bpe_49k.json")
    keep, width = store(spark), token_index.id_width(path)
    listed = keep(token_index.write_shards(frame, folder, path, 2, width, partitions=4), "listed")
    shards = keep(token_index.shard_starts(listed), "shards")
    index = keep(token_index.write_index(
        listed.join(shards.select("path", "shard"), "path"), folder, 3), "index")
    return listed, shards, index, width


def test_token_index(spark, given, tmp_path):
    assert rows_of(queries.op2_token_index(spark, FOLDER), *INDEX) == ordered(brute.token_index(given))
    rows = [*odd.documents(), (None, "a b"), (None, None), (5, "another text of five"),
            (80, "special <|endoftext|> and <|startoftext|>x"), (81, "I'll we've don't　it's")]
    frame = odd.frame(spark, rows)
    listed, shards, index, width = indexed(spark, frame, str(tmp_path / "index"))
    found = token_index.look_up(listed.select("doc_id", "copy"), index, 3, str(tmp_path))
    back = token_index.read_back(found, shards, width, str(tmp_path))
    assert rows_of(back, *INDEX) == ordered(brute.token_index(rows))
    stored = {(r.doc_id, r["copy"]) for r in listed.collect()}
    strangers = spark.range(10_000, 30_000).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("copy"))
    assert token_index.look_up(strangers, index, 3, str(tmp_path)).isEmpty()
    absent = spark.createDataFrame([(5, 7), (61, 9)], "doc_id bigint, copy bigint")
    assert (5, 7) not in stored and token_index.look_up(absent, index, 3, str(tmp_path)).isEmpty()


def test_token_index_of_nothing(spark, empty, tmp_path):
    listed, shards, index, width = indexed(spark, empty, str(tmp_path / "none"))
    found = token_index.look_up(listed.select("doc_id", "copy"), index, 3, str(tmp_path))
    assert token_index.read_back(found, shards, width, str(tmp_path)).isEmpty()


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 20_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n)
    copies = np.arange(n) % 3
    seeds, slots = token_index.build(keys, copies)
    assert sorted(slots) == list(range(n))
    assert (token_index.slots_of(keys, copies, seeds, n) == slots).all()
