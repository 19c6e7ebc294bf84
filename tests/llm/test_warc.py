import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.llm.warc import (
    END, capture_records, chunked, dechunked, page_of, parse_records, read_warc, records_of, write_warc,
)
from strata.session import fresh_dir

SCHEMA = "page_id long, url string, html string, payload string"


def pages(spark, rows):
    return staged(spark, spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3), "pages")


def test_chunked_framing_round_trip():
    rng = random.Random(1)
    for n in (0, 1, 4095, 4096, 4097, 30_000):
        data = rng.randbytes(n)
        for size in (1, 7, 4096) if n < 5000 else (4096,):
            assert dechunked(chunked(data, size)) == data
    assert dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nab", b"zz\r\n", b"2\r\nabX\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            dechunked(bad)


ROWS = [(1, "http://a/", "same"), (2, "http://b/", "same"), (9, None, "same"), (3, "http://c/\r\nX: y", None), (4, "http://d/", ""),
        (5, "http://e/", "line\r\n\r\nWARC/1.1\r\n\r\n" * 50), (6, "u", "é漢😀" * 70_000), (7, "u", "é漢😀" * 70_000),
        (8, "u", "0\r\n\r\n"), (8, "u", "0\r\n\r\n"), (None, "n", "alone"), (None, "n", "same")]


def test_round_trip_and_revisits(spark):
    records = capture_records(spark, pages(spark, ROWS))
    path = fresh_dir(spark, "warc")
    write_warc(records, path, segment_bytes=1000, records_per_file=5)
    got = [r.asDict() for r in read_warc(spark, path).withColumn("page_id", page_of(F.col("record_id")))
           .withColumn("to", page_of(F.col("refers_to"))).collect()]
    assert len(got) == len(ROWS) and not any(r["error"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    for page, url, html in ROWS:
        data = (html or "").encode()
        for r in by[None if page is None else str(page)]:
            if page is not None:
                assert r["payload_bytes"] == len(data)
                assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
                assert r["payload"] == (data if r["type"] == "response" else None)
    kinds = {k: sorted((r["type"], r["to"]) for r in v) for k, v in by.items()}
    assert kinds["9"] == [("response", None)] and kinds["1"] == kinds["2"] == [("revisit", "9")]
    assert kinds["4"] == [("response", None)] and kinds["3"] == [("revisit", "4")]
    assert kinds["7"] == [("response", None)] and kinds["6"] == [("revisit", "7")]
    assert kinds["8"] == [("response", None), ("revisit", "8")]
    assert kinds[None] == [("response", None), ("revisit", "9")]


def test_files_are_warc(spark):
    path = fresh_dir(spark, "warc")
    write_warc(capture_records(spark, pages(spark, ROWS)), path, segment_bytes=5000, compression="gzip")
    found = []
    for r in spark.read.format("binaryFile").load(path).collect():
        data = gzip.decompress(bytes(r.content))
        assert not data or data.endswith(b"\r\n\r\n")
        found += list(parse_records(data))
    long = [r for r in found if r["segment"] is not None]
    assert len(long) > 100 and max(len(r["block"]) for r in found) <= 5000
    assert {r["type"] for r in found} == {"response", "revisit", "continuation"}


def test_broken_segments_are_reported(spark):
    lost = list(records_of("urn:page:1:A:0", "u", b"x" * 5000, None, 1000))
    whole = list(records_of("urn:page:2:A:1", "u", b"y" * 5000, None, 1000))
    short = list(records_of("urn:page:3:A:2", "u", b"z" * 5000, None, 1000))
    short[2] = short[2].replace(b"Content-Length: 1000", b"Content-Length: 999")[:-1]
    orphan = list(records_of("urn:page:4:A:3", "u", b"w" * 5000, None, 1000))[1:]
    raw = [*lost[:2], *lost[3:], *reversed(whole), *short, *orphan, whole[2]]
    path = fresh_dir(spark, "warc")
    df = spark.createDataFrame([(bytearray(x),) for x in raw[:-1]], "r binary").repartition(4)
    df.select(F.col("r").cast("string")).write.option("lineSep", "\r\n\r\n").text(path)
    got = {r.record_id.split(":")[2]: r for r in read_warc(spark, path).collect()}
    assert got["2"].error is None and bytes(got["2"].payload) == b"y" * 5000
    for k in ("1", "3", "4"):
        assert got[k].error and got[k].payload is None


def test_least_bytes_and_empty_table(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    found = capture_records(spark, pages(spark, rows), least_bytes=3).where("refers_to is not null").collect()
    assert [page for page in (r.record_id.split(":")[2] for r in found)] == ["3"]
    path = fresh_dir(spark, "warc")
    write_warc(capture_records(spark, pages(spark, [])), path)
    assert read_warc(spark, path).count() == 0


def test_damaged_archives_give_error_rows(spark):
    """A record cut in its head, one without a length, one cut in its block, and rubbish: the others are read."""
    good = [b"".join(records_of(f"urn:page:{i}:0:0", "u", b"payload %d" % i, None)) + END.encode() for i in range(5)]
    cut = good[1][:40]
    no_length = good[2].replace(b"Content-Length: ", b"X-Length: ", 1)
    long = good[3].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    data = good[0] + cut + b"\r\n\r\n" + no_length + b"rubbish\r\n" + long + good[4]
    found = list(parse_records(data))
    assert [r["record_id"] for r in found if "error" not in r] == ["urn:page:0:0:0", "urn:page:4:0:0"]
    path = fresh_dir(spark, "warc")
    import os
    os.makedirs(path)
    for name, content in (("a", data), ("b", b""), ("c", b"no archive"), ("d", good[1][:-20])):
        with open(f"{path}/{name}", "wb") as f:
            f.write(content)
    rows = read_warc(spark, path).collect()
    assert sorted(bytes(r.payload) for r in rows if not r.error) == [b"payload 0", b"payload 4"]
    assert sum(bool(r.error) for r in rows) >= 5 and all(r.payload is None for r in rows if r.error)
