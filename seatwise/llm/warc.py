"""WARC archives: one gzip member per record, written and read by many tasks.

``write_archives`` gives equal payloads one response record, that of the smallest page
id; the others become revisit records that refer to it. ``read_archives`` reads each
archive from its start to its end in one task: it inflates member by member in small
steps, frames records by Content-Length and checks the digests.

Archives lie in a folder that all executors share, and are reached with pyarrow's file
systems. A task writes under a name of its own and renames at the end, and its result
lists the file, so a repeated task leaves no half archive in the list.

Defined results: a null payload is empty; a null page id is the id -1 in a record's name
and null when read back; pages that share the smallest id and the payload are all
responses; an empty table gives no archives and an empty result. Only the named columns
are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.operators.matching import attach

#: Bytes read from an archive at a time.
STEP = 1 << 18
#: A fixed date, so that the same pages give the same archives.
_DATE = b"2024-01-01T00:00:00Z"
_WRITTEN = "path string, records bigint"
_READ = ("page_id bigint, target_uri string, record_type string, refers_to bigint, "
         "payload_bytes bigint, payload_digest string, payload binary")


def folder_of(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> bytes:
    return b"<urn:page:%d>" % (-1 if page_id is None else page_id)


def _line(value: str | None) -> bytes:
    return " ".join((value or "").split()).encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit carries no payload, only its digest and length."""
    block = payload if refers_to is None else b""
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: " + _name(page_id),
        b"WARC-Date: " + _DATE,
        b"WARC-Target-URI: " + _line(url),
        b"WARC-Payload-Digest: sha1:" + digest(payload).encode(),
        b"WARC-Block-Digest: sha1:" + digest(block).encode(),
        b"X-Payload-Length: %d" % len(payload),
        b"Content-Type: text/html; charset=utf-8",
        b"Content-Length: %d" % len(block),
    ]
    if refers_to is not None:
        head.insert(4, b"WARC-Profile: "
                       b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(5, b"WARC-Refers-To: " + _name(refers_to))
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"
    return deflate.compress(whole) + deflate.flush()


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive.

    Holds one record and one step of the file. Raises ValueError on a broken frame, a
    truncated member or a wrong block digest.
    """
    inflate, plain, raw, begun = zlib.decompressobj(31), bytearray(), b"", False
    while True:
        if not raw:
            raw = stream.read(STEP)
        if not raw:
            # Also true inside a gzip header, before any plain byte.
            if begun:
                raise ValueError("the archive ends inside a record")
            return
        begun = True
        plain += inflate.decompress(raw, STEP)
        raw = inflate.unconsumed_tail
        if inflate.eof:
            raw = inflate.unused_data
            yield _framed(bytes(plain))
            inflate, plain, begun = zlib.decompressobj(31), bytearray(), False


def _framed(member: bytes) -> tuple[dict[str, str], bytes]:
    head, mark, rest = member.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a record")
    fields = {k.decode().lower(): v.strip().decode()
              for k, _, v in (line.partition(b":") for line in lines[1:])}
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's content length is wrong")
    block = rest[:length]
    if fields.get("warc-block-digest") != "sha1:" + digest(block):
        raise ValueError("a record's digest is wrong")
    return fields, block


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write all pages; the result lists the archives: path and number of records.

    Payloads shorter than ``least_bytes`` are responses whatever they equal. First
    pages per payload are found by digest, with partial sums before the shuffle, so
    that a payload of very many pages is one row per task; the look-up of a page's first
    can be split by adaptive execution, so such a payload's records spread over archives.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        payload.alias("payload"),
        F.concat(F.sha1(payload), F.lit(":"), F.octet_length(payload)).alias("_key"),
    )
    firsts = rows.groupBy("_key").agg(F.min("page_id").alias("_first"))
    rows = attach(rows, firsts, ["_key"]).select(
        "page_id", "url", "payload",
        F.when((F.col("page_id") > F.col("_first"))
               & (F.octet_length("payload") >= least_bytes), F.col("_first")).alias("refers_to"),
    )

    def write(batches):
        where, base = folder_of(folder)
        out, path, count = None, f"{base}/{uuid.uuid4().hex}", 0
        for batch in batches:
            if out is None and batch.num_rows:
                where.create_dir(base)
                out = where.open_output_stream(f"{path}.part", compression=None)
            for row in batch.to_pylist():
                out.write(record(row["page_id"], row["url"], row["payload"], row["refers_to"]))
                count += 1
        if out is not None:
            out.close()
            where.move(f"{path}.part", f"{path}.warc.gz")
            yield pa.RecordBatch.from_pydict({"path": [f"{path}.warc.gz"], "records": [count]})

    return rows.mapInArrow(write, _WRITTEN)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """All records of the listed archives; each archive is read by one task."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ])

    def number(name: str | None) -> int | None:
        if name is None:
            return None
        found = int(name.removeprefix("<urn:page:").removesuffix(">"))
        return None if found == -1 else found

    def read(batches):
        where, _ = folder_of(folder)
        for batch in batches:
            for path, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held, seen = [], 0, 0
                with where.open_input_stream(path, compression=None) as stream:
                    for fields, block in records_of(stream):
                        rows.append({
                            "page_id": number(fields["warc-record-id"]),
                            "target_uri": fields["warc-target-uri"],
                            "record_type": fields["warc-type"],
                            "refers_to": number(fields.get("warc-refers-to")),
                            "payload_bytes": int(fields["x-payload-length"]),
                            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
                            "payload": block,
                        })
                        seen, held = seen + 1, held + len(block)
                        if held > 4 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                if seen != records:
                    raise ValueError(f"{path}: {seen} records, {records} were written")

    return archives.select("path", "records").mapInArrow(read, _READ)
