"""WARC archives: writing, and reading back with segment reassembly.

Method. A record's block is an HTTP response whose body is in chunked transfer
framing. A block longer than a segment is written as one first record and
continuation records. Reading groups the records of a segmented block by the
identifier of their origin, orders them by segment number, checks that the
numbers run from 1 without a gap and that the lengths add up to the total
length, and decodes the chunked framing.

Records with the same payload are written once: the others become revisit
records that name the first and carry no payload.

Files are written by Spark's text writer, whose line separator is the two line
ends that close a WARC record, so any store that Spark writes to will do; the
payload may hold any bytes. Payloads move once, by row key, and only to meet
the (narrow) revisit decisions; a segmented block meets in one task, never more
than one payload.

Defined cases: a null payload is empty; a null id is smaller than any other and
a null URL is written empty and read as null; repeated rows are records of
their own; a block with a missing or doubled segment, a wrong total length or
broken framing is returned with its ``error`` and no payload; an empty table
writes no record; further columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import FILE, KEYS, ROW, keyed, scanned, slices, staged

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 4096
RECORDS_PER_FILE = 1000
#: Payloads of fewer bytes are never made revisits.
LEAST_BYTES = 0

# Fixed values of the formats.
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
DATE = b"2024-01-31T00:00:00Z"
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STATUS = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    out = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; trailers are passed over."""
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            raise ValueError("chunk size without end")
        size = int(body[at:stop].split(b";")[0].strip() or b"x", 16)
        at = stop + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(body[at:at + size])
        at += size + 2


def _record(headers: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    lines = [VERSION, *[k + b": " + v for k, v in headers], b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def records_of(record_id: str, url: str, payload: bytes, refers_to: str | None,
               segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The WARC records of a capture, each without the two line ends that close it."""
    name, digest = f"<{record_id}>".encode(), b"sha1:" + payload_digest(payload).encode()
    clean = "".join(c for c in url if c not in "\r\n").encode("utf-8", "replace")
    base = [(b"WARC-Target-URI", clean), (b"WARC-Date", DATE), (b"WARC-Payload-Digest", digest),
            (b"Content-Type", b"application/http; msgtype=response")]
    if refers_to is not None:
        block = STATUS + b"Content-Length: %d\r\n\r\n" % len(payload)
        yield _record([(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", name), *base, (b"WARC-Profile", REVISIT),
                       (b"WARC-Refers-To", f"<{refers_to}>".encode())], block)
        return
    block = STATUS + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    first = [(b"WARC-Type", b"response"), (b"WARC-Record-ID", name), *base]
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record(first, block)
        return
    yield _record([*first, (b"WARC-Segment-Number", b"1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        own = [(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", f"<{record_id}:{n}>".encode()),
               (b"WARC-Date", DATE), (b"WARC-Segment-Origin-ID", name), (b"WARC-Segment-Number", b"%d" % n)]
        if n == len(parts):
            own.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        yield _record(own, part)


def _writer(segment_bytes: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            out: list[bytes] = []
            for r in batch.to_pylist():
                out += records_of(r["record_id"], r["url"] or "", r["payload"] or b"", r["refers_to"], segment_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return write


def write_warc(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
               records_per_file: int = RECORDS_PER_FILE, compression: str = "none") -> None:
    """Write ``(record_id, url, payload, refers_to)`` rows as archives under ``path``."""
    rows = records.select("record_id", "url", "payload", "refers_to").mapInArrow(
        _writer(segment_bytes), "record binary")
    # a cast keeps the bytes as they are; the separator closes each record
    (rows.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END).option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))


_RESULT = ("record_id string, type string, url string, refers_to string, payload_bytes long, "
           "payload_digest string, error string, payload binary")
_PARSED = _RESULT + ", digest string, origin string, segment int, total long, block binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _record_at(data: bytes, at: int) -> tuple[dict, int]:
    """The record at a byte of an archive, and the byte after it."""
    head = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/", at) or head < 0:
        raise ValueError(f"no WARC record at byte {at}")
    fields = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        fields[key.strip().lower()] = value.strip()
    size = int(fields.get(b"content-length", b"none"))
    block = data[head + 4:head + 4 + size]
    if size < 0 or len(block) < size:
        raise ValueError(f"record at byte {at} is cut short")
    text = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None
    name = lambda k: text(k).strip("<>") if k in fields else None
    number = lambda k: int(fields[k]) if k in fields else None
    record = {"record_id": name(b"warc-record-id"), "type": text(b"warc-type") or "",
              "url": text(b"warc-target-uri") or None, "refers_to": name(b"warc-refers-to"),
              "digest": (text(b"warc-payload-digest") or "").removeprefix("sha1:"),
              "origin": name(b"warc-segment-origin-id"), "segment": number(b"warc-segment-number"),
              "total": number(b"warc-segment-total-length"), "block": block}
    end = head + 4 + size
    while data[end:end + 2] == b"\r\n":
        end += 2
    return record, end


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of an archive's bytes.

    What cannot be read as a record gives ``{"error": ...}`` once, and reading
    goes on at the next line that begins one.
    """
    at = 0
    while at < len(data):
        try:
            record, end = _record_at(data, at)
        except ValueError as error:
            record, end = {"error": str(error)}, data.find(b"\nWARC/", at) + 1 or len(data)
        yield record
        at = end


def _payload(kind: str, block: bytes, digest: str) -> tuple[bytes | None, int, str]:
    """Payload (none for a revisit), its length and its digest, of a whole block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(x.lower().split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
    if kind == "revisit":
        return None, int(fields[b"content-length"]), digest
    if fields.get(b"transfer-encoding", b"").strip() == b"chunked":
        body = dechunked(body)
    found = payload_digest(body)
    if digest and found != digest:
        raise ValueError("payload digest differs")
    return body, len(body), found


def _decoded(record: dict, parts: list[dict], payloads: bool) -> dict:
    """The result row of a record from the parts of its block, in order."""
    row = {k: record[k] for k in ("record_id", "type", "url", "refers_to")}
    try:
        if parts[0]["segment"] is not None:
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError("segments are missing or doubled")
            if sum(len(p["block"]) for p in parts) != parts[-1]["total"]:
                raise ValueError("total length differs")
        block = b"".join(p["block"] for p in parts)
        payload, row["payload_bytes"], row["payload_digest"] = _payload(record["type"], block, record["digest"])
        row["payload"] = payload if payloads else None
    except (ValueError, KeyError) as error:
        row["error"] = str(error) or "broken record"
    return row


def _parser(payloads: bool) -> Callable:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records as results; records of segments as they are."""
        schema = _schema(_PARSED)
        for batch in batches:
            for k in range(batch.num_rows):
                out, size = [], 0
                for r in parse_records(batch.column("content")[k].as_buffer().to_pybytes()):
                    alone = "error" not in r and r["segment"] is None
                    out.append(_decoded(r, [r], payloads) if alone else r)
                    size += len(r.get("block", b""))
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    return parse


def _joiner(payloads: bool) -> Callable:
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one block at a time
                r = batch.slice(k, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist([_decoded(r, r["parts"], payloads)], schema=_schema(_RESULT))

    return join


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record that is not a continuation.

    Columns: ``record_id, type, url, refers_to, payload_bytes, payload_digest,
    error`` and, with ``payloads``, ``payload`` (null for a revisit). Only
    segments are moved; a record in one piece is decoded where it is read.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    found = spark.read.format("binaryFile").schema(schema).load(path).select("content").mapInArrow(
        _parser(payloads), _PARSED)
    found = staged(spark, found, "warc-records")
    columns = [f.name for f in found.schema.fields][:8]
    first = lambda c: F.max(F.when(F.col("type") != "continuation", F.col(c))).alias(c)
    joined = (found.where("segment IS NOT NULL").groupBy(F.coalesce("origin", "record_id").alias("of"))
              .agg(F.max(F.when(F.col("type") != "continuation", F.col("type"))).alias("kind"), first("url"),
                   first("refers_to"), first("digest"),
                   F.sort_array(F.collect_list(F.struct("segment", "total", "block"))).alias("parts"))
              .select(F.col("of").alias("record_id"), F.coalesce("kind", F.lit("continuation")).alias("type"),
                      "url", "refers_to", "digest", "parts"))
    out = found.where("segment IS NULL").select(*columns).union(joined.mapInArrow(_joiner(payloads), _RESULT))
    return out if payloads else out.drop("payload")


def capture_records(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", url: str = "url",
                    payload: Column | None = None, least_bytes: int = LEAST_BYTES,
                    scan: bool = False) -> DataFrame:
    """``(record_id, url, payload, refers_to)`` of a table of captures.

    Of captures with equal payloads of at least ``least_bytes``, that with the
    largest id (then the last place in the input files) is a response; the
    others refer to it.
    """
    pages = scanned(spark, pages, scan)
    body = F.coalesce(F.encode(F.col("html"), "utf-8") if payload is None else payload, F.lit(b""))
    rows = staged(spark, keyed(spark, pages, F.col(f"`{page_id}`").alias("id"), F.unhex(F.sha1(body)).alias("digest"),
                               F.length(body).alias("bytes"), scan=True), "payload-digests")
    heads = staged(spark, rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(
        F.max(F.struct("id", *KEYS)).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("digest", F.col("head.id").alias("head_id"), F.col(f"head.{FILE}").alias("head_file"),
                F.col(f"head.{ROW}").alias("head_row")), "payload-heads")
    again = staged(spark, rows.where(F.col("bytes") >= least_bytes).join(heads, "digest")
                   .where(~((F.col(FILE) == F.col("head_file")) & (F.col(ROW) == F.col("head_row"))))
                   .select(*KEYS, _name("head_id", "head_file", "head_row").alias("refers_to")), "revisits")
    full = keyed(spark, pages, F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").alias("url"),
                 body.alias("payload"), scan=True)
    return full.join(again, list(KEYS), "left").select(
        _name("id", FILE, ROW).alias("record_id"), "url", "payload", "refers_to")


def _name(page_id: str, file: str, row: str) -> Column:
    """A record's identifier: the page's id and the row's place, which makes it unique."""
    return F.concat(F.lit("urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(":"),
                    F.hex(file), F.lit(":"), F.col(row).cast("string"))


def page_of(name: Column) -> Column:
    """The page's id in a record's identifier."""
    return F.nullif(F.split_part(name, F.lit(":"), F.lit(3)), F.lit(""))
