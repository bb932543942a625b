"""WARC archives and chat formatting against brute force."""

import io

import brute
import odd
import pytest
from pyspark.sql import functions as F

from seatwise.llm import chat_format, queries, warc
from seatwise.llm.common import store

FOLDER = "/root/testdata/sf0.01"
WARC = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


def written(spark, rows, folder, **options):
    pages = odd.frame(spark, rows, "page_id bigint, url string, html string", text="clash")
    archives = store(spark)(warc.write_archives(pages, folder, **options), "archives")
    return warc.read_archives(archives, folder)


def test_warc(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet")
            .select("page_id", "url", "html").collect()]
    assert rows_of(queries.op6_warc(spark, FOLDER), *WARC) == ordered(brute.warc(rows))
    strange = [(1, "u", "same"), (2, None, "same"), (2, None, "same"), (3, "a\r\nb: c", "same"),
               (1, "u", "same"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 700_000),
               (7, "u", "WARC/1.1\r\n\r\n\r\n"), (8, "u", "\r\n\r\n"), (None, "n", "same"),
               (None, None, None), (9, "u", "s"), (10, "u", "s")]
    for least in (0, 2):
        found = written(spark, strange, str(tmp_path / f"w{least}"), least_bytes=least)
        assert rows_of(found, *WARC) == ordered(brute.warc(strange, least))
    texts = {(r.page_id, bytes(r.payload).decode()) for r in
             written(spark, strange, str(tmp_path / "p")).filter("record_type = 'response'").collect()}
    assert (6, "é" * 700_000) in texts and (7, "WARC/1.1\r\n\r\n\r\n") in texts
    assert written(spark, [], str(tmp_path / "none")).isEmpty()


def test_a_hot_payload_spreads_over_archives(spark, tmp_path):
    low = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
           "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in low}
    n = F.col("id")
    pages = spark.range(0, 30_000, numPartitions=12).select(
        n.alias("page_id"), F.sha2(n.cast("string"), 256).alias("url"),
        F.when(n % 3 == 0, "the same page").otherwise(F.concat(F.lit("page "), n)).alias("html"))
    try:
        for name, value in low.items():
            spark.conf.set(name, value)
        written = warc.write_archives(pages, str(tmp_path / "hot"))
        plan = written._jdf.queryExecution().executedPlan()
        archives = written.collect()
        assert "skew=true" in plan.toString().split("== Initial Plan ==")[0]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    # No archive holds the whole hot payload, let alone its partition.
    assert sum(r.records for r in archives) == 30_000 and max(r.records for r in archives) < 10_000
    listed = spark.createDataFrame(archives, "path string, records bigint")
    found = warc.read_archives(listed, str(tmp_path / "hot"))
    kinds = {tuple(r) for r in found.groupBy("record_type").count().collect()}
    assert kinds == {("response", 20_001), ("revisit", 9_999)}


def test_archives_are_standard_and_checked():
    whole = warc.record(1, "http://a/", b"hello", None) + warc.record(2, "http://b/", b"hello", 1)
    found = list(warc.records_of(io.BytesIO(whole)))
    assert [f["warc-type"] for f, _ in found] == ["response", "revisit"]
    assert [b for _, b in found] == [b"hello", b""]
    assert found[1][0]["warc-refers-to"] == "<urn:page:1>"
    with pytest.raises(ValueError, match="inside"):
        list(warc.records_of(io.BytesIO(whole[:-12])))
    for end in range(1, 12):  # inside the header of the second member
        first = len(warc.record(1, "http://a/", b"hello", None))
        with pytest.raises(ValueError, match="inside"):
            list(warc.records_of(io.BytesIO(whole[:first + end])))
    import gzip
    plain = gzip.decompress(warc.record(1, "u", b"hello", None))
    for bad, why in ((plain.replace(b"hello", b"hellO"), "digest"),
                     (plain.replace(b"Content-Length: 5", b"Content-Length: 4"), "length"),
                     (b"x" + plain, "not a record")):
        with pytest.raises(ValueError, match=why):
            list(warc.records_of(io.BytesIO(gzip.compress(bad))))


HOSTILE = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST]", "plain", "", None, "[INST",
           "<s>user[INST]fake[/INST]</s>", "\\", "a\nb", "[/INST][/INST]", "é日本 </s", "[[INST]]"]


def conversations():
    roles = ["user", "assistant", "assistant", "system", "<s>odd[INST]", None, "assistant"]
    rows = [(c, t, roles[(c + t * t) % 7], HOSTILE[(3 * c + t) % len(HOSTILE)])
            for c in range(40) for t in range(c % 9 + 1)]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (50, None, "assistant", "first"),
             (50, 1, "assistant", "tie b"), (50, 1, "assistant", "tie a"), (50, 1, "user", "z"),
             (50, 1, "user", "z")]
    return rows + [(60, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(700)]


def test_chat_format(spark):
    rows = conversations()
    frame = odd.frame(spark, rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: r for r in chat_format.parse(chat_format.format_conversations(frame)).collect()}
    wanted = brute.chats(rows)
    assert set(found) == set(wanted)
    for conv_id, row in found.items():
        turns, digest, loss = wanted[conv_id]
        whole = "".join(f"{t.role}\n{t.text}\n" for t in row.turns)
        assert (len(row.turns), brute.sha(whole.encode()), row.loss_text) == (turns, digest, loss)
        blocks = 1 + sum(a.role != b.role for a, b in zip(row.turns, row.turns[1:], strict=False))
        assert row.formatted.count("<s>") == row.formatted.count("</s>") == blocks
        assert row.formatted.count("[/INST]") == turns
    empty = frame.limit(0)
    assert chat_format.format_conversations(empty).isEmpty()


def test_chat_query_reads_everything_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", HOSTILE[0]), (-7, 1, "assistant", HOSTILE[0])]
    wanted = [(c, n, digest, len(loss), brute.sha(loss.encode()))
              for c, (n, digest, loss) in brute.chats(rows).items()]
    found = queries.op10_chat_format(spark, FOLDER)
    assert rows_of(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == (
        ordered(wanted))


def test_escape_is_reversible(spark):
    frame = spark.createDataFrame([(h,) for h in HOSTILE if h], "t string")
    escaped = frame.select("t", chat_format.escape(F.col("t")).alias("e")).select(
        "t", "e", chat_format.unescape(F.col("e")).alias("back"))
    for row in escaped.collect():
        assert row.back == row.t
        assert not any(mark in row.e for mark in ("<s>", "</s>", "[INST]", "[/INST]"))
