"""WARC archives: one gzip member per record, read back in sequence.

``write`` turns pages into records and has Spark's text writer put them down as raw bytes, so
archives land on whatever file system the folder is on, under Spark's commit protocol. Several
records make one segment, the value of one row; the writer ends each row with a line separator,
and that separator is itself a gzip member with a small ``warcinfo`` record, so a file is a
sequence of gzip members with one record each and nothing else.

``read`` walks each archive once: it inflates members incrementally, frames records by their
content lengths and checks both digests. Damaged archives raise an error.

Of pages with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the largest
page_id is a response and the others are revisits of it; repeated rows of that page_id are all
responses. Null html is the empty payload; a null url is left out; a null page_id is written as
``none`` and read back as null, and is never the one referred to. Other columns of the pages are
not archived. Pages share a record id only if they share a page_id.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16  # copies of a payload are spread over so many join keys


@dataclass(frozen=True)
class WarcParams:
    min_revisit_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6
    segment_bytes: int = 4 << 20
    segments_a_file: int = 8


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, block: bytes, date: str, more: dict[str, str | None]) -> bytes:
    """One record, uncompressed."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, **more,
              "WARC-Block-Digest": f"sha1:{base32_sha1(block)}", "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if url is not None:
        url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    more = {"WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
            "Content-Type": "application/http; msgtype=response"}
    name = "urn:page:" + ("none" if page_id is None else str(page_id))
    if refers_to is None:
        return record("response", name, http + payload, date, more)
    more |= {"WARC-Refers-To": f"<urn:page:{refers_to}>",
             "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"}
    return record("revisit", name, http, date, more)


def member(data: bytes, level: int) -> bytes:
    return gzip.compress(data, level, mtime=0)


def with_originals(pages: DataFrame, p: WarcParams) -> DataFrame:
    """page_id, url, html and refers_to, the page whose payload this page repeats (else null)."""
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("__digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("__salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    same = (page.where(F.octet_length("html") >= p.min_revisit_bytes).groupBy("__digest")
            .agg(F.max("page_id").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1 AND __first IS NOT NULL")
            .select("__digest", "__first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")))
    joined = page.join(same, ["__digest", "__salt"], "left")
    again = F.when(~F.col("__first").eqNullSafe(F.col("page_id")), F.col("__first"))
    return joined.select("page_id", "url", "html", again.alias("refers_to"))


def write(pages: DataFrame, path: str, p: WarcParams = WarcParams()) -> None:
    """Archives the pages in a new folder."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                held.append(member(page_record(page_id, url, html.encode(), refers_to, p.date), p.level))
                size += len(held[-1])
                if size >= p.segment_bytes:
                    yield pa.RecordBatch.from_pydict({"data": pa.array([b"".join(held)], pa.binary())})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"data": pa.array([b"".join(held)], pa.binary())})

    info = member(record("warcinfo", "urn:segment:end", b"format: WARC File Format 1.0\r\n", p.date, {"Content-Type": "application/warc-fields"}), 9)
    # a cast from binary to string keeps the bytes, and the text writer writes a string's bytes
    (with_originals(pages, p).mapInArrow(segments, "data binary").select(F.col("data").cast("string").alias("value"))
     .write.option("lineSep", info.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", p.segments_a_file).text(path))


def members(data: memoryview, step: int = 1 << 16) -> Iterator[bytes]:
    """The inflated gzip members of an archive, one after the other."""
    at = 0
    while at < len(data):
        inflate, parts = zlib.decompressobj(wbits=31), []
        while not inflate.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a gzip member")
            piece = data[at:at + step]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of the one record of a member, framed by its content length."""
    end = data.find(b"\r\n\r\n")
    first, *lines = data[:max(end, 0)].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("a gzip member doesn't start with a record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    size = int(fields["content-length"])
    block = data[end + 4:end + 4 + size]
    if len(block) != size or data[end + 4 + size:] != b"\r\n\r\n":
        raise ValueError("a record doesn't have its content length")
    if fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"wrong block digest in {fields['warc-record-id']}")
    return fields, block


def pages_of(archive: memoryview) -> Iterator[dict]:
    """The page records of an archive, digests checked."""
    for data in members(archive):
        fields, block = parse(data)
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
            raise ValueError(f"wrong payload in {fields['warc-record-id']}")
        page, refers = (re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(k, "")) for k in ("warc-record-id", "warc-refers-to"))
        yield {"page_id": page and int(page[1]), "url": fields.get("warc-target-uri"), "record_type": kind,
               "refers_to": refers and int(refers[1]), "payload_digest": digest, "payload_bytes": length,
               "payload": payload if kind == "response" else None}


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the archives in a folder; the payload of a revisit is null."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
             "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema(list(kinds.items()))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield from batched(pages_of(memoryview(content.as_buffer())))

    def batched(rows: Iterable[dict], most: int = 256) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows:
            held.append(row)
            if len(held) == most:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
            .mapInArrow(records, "page_id long, url string, record_type string, refers_to long, payload_digest string, "
                                 "payload_bytes long, payload binary"))
