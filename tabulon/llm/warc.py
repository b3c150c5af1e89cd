"""WARC records as a chunked table: written, deduplicated by payload, and read back as a stream of chunks."""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.plans.shared import broadcast_if_small, materialise

CHUNK = 1 << 16
# Revisits sent to every executor at most, about 60 bytes each; beyond that the pages are shuffled to them.
REVISITS_BROADCAST = 200_000
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FLUSH = 4 << 20


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:unknown"


def _record_id(page: int | None) -> str:
    return f"<tag:record,2000:{'' if page is None else page}>"


def _head(page, url, size: int, digest: str, refers) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _record_id(page)),
              ("WARC-Date", _DATE), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers is not None:
        fields += [("WARC-Refers-To", _record_id(refers)), ("WARC-Profile", _PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"),
               ("Content-Length", str(len(http) + (size if refers is None else 0)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n" + http).encode()


def _named(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))
    return pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        body.alias("body")).withColumn("key", F.sha2("body", 256))


def chunk_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                  chunk: int = CHUNK, least: int = 0) -> DataFrame:
    """(record, chunk, chunks, data, sha1): the WARC records of the pages as numbered chunks.

    A record's chunks, joined in order, are its WARC bytes; ``sha1`` is the running digest of the payload up to
    the chunk's end.  Of equal payloads of ``least`` bytes or more, the smallest page_id is a response and the
    others are revisits without payload.

    Null pages are empty payloads; rows without a page_id are responses that nobody refers to; repeated rows are
    records each.  Other columns are not read.
    """
    named = _named(pages, page_id, url, html)
    facts = materialise(named.select("page_id", "key", F.octet_length("body").alias("n")), "payloads").filter(
        (F.col("n") >= least) & F.col("page_id").isNotNull())
    first = facts.groupBy("key").agg(F.min("page_id").alias("refers"), F.max("page_id").alias("z")).filter(
        "refers < z").select("key", "refers")
    revisits = materialise(facts.join(first, "key").filter("page_id > refers").select(
        "page_id", "key", "refers").distinct(), "revisits")
    rows = named.join(broadcast_if_small(revisits, REVISITS_BROADCAST), ["page_id", "key"], "left").select(
        "page_id", "url", "body", "refers")

    def run(batches):
        record, out, size = TaskContext.get().partitionId() << 36, [], 0

        def batch():
            cols = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string()))],
                names=["record", "chunk", "chunks", "data", "sha1"])

        for b in batches:
            for i in range(b.num_rows):
                page, link, refers = (b.column(c)[i].as_py() for c in (0, 1, 3))
                body = memoryview(b.column(2)[i].as_buffer())
                n, running = len(body), hashlib.sha1()
                head = _head(page, link, n, _base32(hashlib.sha1(body).digest()), refers)
                parts = max(1, -(-n // chunk)) if refers is None else 1
                for k in range(parts):
                    part = bytes(body[k * chunk:(k + 1) * chunk]) if refers is None else b""
                    running.update(part)
                    data = (head if k == 0 else b"") + part + (b"\r\n\r\n" if k == parts - 1 else b"")
                    out.append((record, k, parts, data, running.hexdigest()))
                    size += len(data)
                    if size > _FLUSH:
                        yield batch()
                        size = 0
                record += 1
        yield batch()

    return rows.mapInArrow(run, "record long, chunk int, chunks int, data binary, sha1 string")


def _parse(batches):
    """Records from chunks in order; one chunk is held at a time, with the running digest of its record."""
    rows, head, digest, seen = [], None, None, 0
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def fields(block: bytes) -> dict[str, str]:
        return dict(line.split(": ", 1) for line in block.decode().split("\r\n")[1:] if ": " in line)

    def number(record_id: str | None):
        found = re.fullmatch(r"<tag:record,2000:(-?\d+)>", record_id or "")
        return int(found[1]) if found else None

    def close(length):
        kind = head["WARC-Type"]
        named = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (_base32(digest.digest()) != named or seen != length):
            raise ValueError(f"record {head['WARC-Record-ID']} does not hold the payload it names")
        rows.append((number(head["WARC-Record-ID"]), length, named, kind, number(head.get("WARC-Refers-To"))))

    for b in batches:
        for i in range(b.num_rows):
            k, chunks, data, running = (b.column(c)[i].as_py() for c in range(1, 5))
            if k == 0:
                warc, http, data = data.split(b"\r\n\r\n", 2)
                head, digest, seen, due = fields(warc), hashlib.sha1(), 0, 0
                length = int(fields(http)["Content-Length"])
            if k != due:
                raise ValueError(f"record {head['WARC-Record-ID']} lacks chunk {due}")
            payload = data[:-4] if k == chunks - 1 else data
            digest.update(payload)
            seen, due = seen + len(payload), due + 1
            if digest.hexdigest() != running:
                raise ValueError(f"record {head['WARC-Record-ID']} is damaged in chunk {k}")
            if due == chunks:
                close(length)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type",
                                                    "refers_to"])
            rows.clear()


def read_records(table: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record of a chunk table.

    Records of one chunk are read in place; chunks of longer ones are brought together by record and streamed in
    order.  A missing or damaged chunk raises an error.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    table = table.select("record", "chunk", "chunks", "data", "sha1")
    long = table.filter("chunks > 1").repartition("record").sortWithinPartitions("record", "chunk")
    return table.filter("chunks = 1").mapInArrow(_parse, schema).unionByName(long.mapInArrow(_parse, schema))


def write_archive(pages: DataFrame, path: str, **named) -> None:
    """Store ``chunk_records`` as a table at ``path``."""
    chunk_records(pages, **named).write.parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark.read.parquet(path))
