"""WARC chunk tables: round trip, dedup by payload, damage."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tabulon.llm import warc


def pages(spark):
    rows = [(5, "http://a/ b", "same"), (3, "http://c", "same"), (9, None, None), (8, "http://d", ""), (7, "u", "é" * 100),
            (11, "u", "x" * 1000), (12, "u", "x" * 1000), (13, "u", "a\r\n\r\nb\r\n\r\n"), (None, "u", "same"),
            (7, "u", "é" * 100)]
    return spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, chunk int"), rows


def brute(rows, least=0):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        same = p is not None and first[h or ""] != p and len(body) >= least
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if same else "response", first[h or ""] if same else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk,least", [(64, 0), (1 << 16, 0), (7, 5)])
def test_round_trip(spark, tmp_path, chunk, least):
    df, rows = pages(spark)
    path = str(tmp_path / "a")
    warc.write_archive(df.repartition(3), path, chunk=chunk, least=least)
    assert sorted(map(tuple, warc.read_archive(spark, path).collect()), key=repr) == brute(rows, least)


def test_bytes_are_warc(spark):
    df, _ = pages(spark)
    chunks = warc.chunk_records(df.filter("page_id = 11"), chunk=300).orderBy("chunk").collect()
    data = b"".join(bytes(c.data) for c in chunks)
    assert len(chunks) == 4 and data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    head, rest = data.split(b"\r\n\r\n", 1)
    length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
    assert rest[length:] == b"\r\n\r\n" and rest[:length].endswith(b"x" * 1000)
    assert chunks[-1].sha1 == hashlib.sha1(b"x" * 1000).hexdigest()


def test_damage_is_found(spark):
    df, _ = pages(spark)
    table = warc.chunk_records(df, chunk=300)
    with pytest.raises(Exception, match="lacks chunk|damaged"):
        warc.read_records(table.filter("chunk <> 1")).collect()
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(table.withColumn("data", F.expr("if(chunk = 1, cast('y' as binary), data)"))).collect()


def test_empty(spark):
    df, _ = pages(spark)
    assert warc.read_records(warc.chunk_records(df.limit(0))).count() == 0
