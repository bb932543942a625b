"""The corpus pipeline, stage by stage, each on what the one before it kept."""

import brute
import corpus_pipeline as pipeline
import odd

FOLDER = "/root/testdata/sf0.001"


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == [
        "quality", "near_duplicates", "repeats", "leaks", "token_ids"]
    found = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        found[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = found[name][1]
    for name in ("quality", "near_duplicates", "repeats", "leaks"):
        before, after = found[name]
        assert after.dtypes == before.dtypes

    before, after = found["quality"]
    failed = {r[0] for r in brute.quality(rows_of(before, "doc_id", "text")) if r[-1]}
    gone = {r.doc_id for r in before.subtract(after).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert failed <= gone and all(labels.get(d, 0) == 0 for d in gone - failed)

    before, after = found["near_duplicates"]
    classes = brute.classes(rows_of(before, "doc_id", "text"))
    assert rows_of(after, "doc_id") == sorted(((d,) for d in set(classes.values())), key=repr)

    before, after = found["repeats"]
    sizes = {d: n - gone for d, n, gone, *_ in brute.suffix(rows_of(before, "doc_id", "text"))}
    for row in after.collect():
        assert 0 <= len(row.text.encode()) - sizes[row.doc_id] <= 40
        assert row.n_chars == len(row.text)
    assert sum(sizes.values()) < sum(len(r.text.encode()) for r in before.collect())

    before, after = found["leaks"]
    items = rows_of(spark.read.parquet(f"{FOLDER}/benchmark.parquet"), "item_id", "text")
    bad = {d for d, *_ in brute.leaks(rows_of(before, "doc_id", "text"), items)}
    assert rows_of(after, "doc_id") == [r for r in rows_of(before, "doc_id") if r[0] not in bad]

    before, after = found["token_ids"]
    wanted = sorted(brute.bpe(rows_of(before, "doc_id", "text")), key=repr)
    assert rows_of(after, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted
    whole = pipeline.run(spark, FOLDER)
    assert rows_of(whole, *after.columns) == rows_of(after, *after.columns)


def test_stages_take_odd_and_empty_tables(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(d, t, None if i % 7 == 0 else "en", "s", None) for i, (d, t) in enumerate(odd.documents())]
    rows.append((None, None, None, None, None))
    for table in (rows, []):
        for _, stage in pipeline.STAGES:
            docs = spark.createDataFrame(table, schema)
            stage(spark, docs, FOLDER).collect()
