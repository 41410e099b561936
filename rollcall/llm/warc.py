"""WARC archives: records with segments and chunked framing, written by Spark's text writer, read back and reassembled."""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm.store import Kept
from rollcall.llm.text import need

END = "\r\n\r\n"  # after every record
SEGMENT = 32 * 1024  # bytes of block in one record; what is longer continues in further records
CHUNK = 4 * 1024  # bytes of payload in one chunk of the transfer framing
RECORDS = 1_000  # records of one archive: with SEGMENT they bound its size
DATE = "2024-01-01T00:00:00Z"
REVISIT_FROM = 100  # bytes of payload from which an equal one is only referred to
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


# --- writing ----------------------------------------------------------------------------------------------------

def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5('|'.join(map(str, parts)).encode()).digest())}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """A payload in chunked transfer framing."""
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + b"\r\n\r\n" + block


def records_of(page_id, url: str | None, payload: bytes, digest: str, refers_to, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    uri = None if url is None else "".join(url.split())
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("X-Page-Id", page_id)]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(page_id, digest, "revisit")), *common,
                       ("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                       ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")],
                      _HTTP + b"\r\n")
        return
    block, own = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload), record_id(page_id, digest)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment:
        yield _record(first, block)
        return
    yield _record([*first, ("WARC-Segment-Number", 1)], block[:segment])
    count = -(-len(block) // segment)
    for k in range(2, count + 1):
        yield _record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, digest, k)), *common,
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
            ("WARC-Segment-Total-Length", len(block) if k == count else None)], block[(k - 1) * segment:k * segment])


def _records(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                for r in records_of(page, url, (html or "").encode("utf-8"), digest, refers, segment):
                    out.append(r)
                    size += len(r)
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write_warc(pages: DataFrame, path: str, segment: int = SEGMENT, records: int = RECORDS) -> None:
    """Write one response or revisit record per row of ``pages`` (page_id, url, html) to gzip archives below ``path``.

    Of equal payloads of at least 100 bytes the one of the smallest page_id is a
    response and the others revisit it. Rows without a page_id and repeated rows
    of the smallest one are responses too. A null html is an empty payload, a null
    url is left out; other columns are not read; no rows give no archive. Payloads
    are shuffled once, by page; what tells revisits apart is a digest and an id.
    Any file system that Spark can write will do, and a lost task is written anew.
    """
    pages = need(pages, "page_id", "url", "html")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    prints = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("bytes"))
    large = prints.where(f"page_id is not null and bytes >= {REVISIT_FROM}").select("page_id", "digest")
    firsts = Kept(large.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where(
        "first < last").select("digest", "first"), "warc-digests")
    again = large.join(firsts.rows, "digest").where("page_id <> first").select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "first").distinct()
    marked = pages.withColumn("digest", F.sha2(payload, 256)).join(
        again, (F.col("page_id") == F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    made = marked.select("page_id", "url", "html", "digest", "first").mapInArrow(_records(segment), "record binary")
    made.select(F.col("record").cast("string")).write.option("lineSep", END).option(
        "maxRecordsPerFile", records).option("compression", "gzip").text(path)
    firsts.drop()


# --- reading ----------------------------------------------------------------------------------------------------

def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of one archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record here: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        yield fields, block


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP message; None where its chunked framing is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    fields = dict(line.lower().split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line) if gap else {}
    if b"chunked" not in fields.get(b"transfer-encoding", b""):
        return body
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        try:
            size = int(body[at:stop].split(b";")[0], 16)
        except ValueError:
            return None
        if stop < 0 or size < 0 or len(body) < stop + 2 + size:
            return None
        if not size:
            return b"".join(out)
        out.append(body[stop + 2:stop + 2 + size])
        at = stop + 4 + size


_PARSED = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("refers_id", pa.string()), ("digest", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
    ("block", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("complete", pa.bool_())])
_PARSED_DDL = ("record_id string, record_type string, page_id long, url string, refers_id string, digest string, segment int, "
               "total long, block binary, payload binary, payload_bytes long, payload_digest string, complete boolean")


def _row(fields: dict, block: bytes | None, payload: bytes | None, with_payload: bool, segment=None, total=None) -> dict:
    digest = (fields.get("warc-payload-digest") or "").removeprefix("sha256:") or None
    found = None if payload is None else hashlib.sha256(payload).hexdigest()
    page = fields.get("x-page-id")
    return {
        "record_id": fields.get("warc-segment-origin-id") or fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
        "page_id": None if page in (None, "None") else int(page), "url": fields.get("warc-target-uri"),
        "refers_id": fields.get("warc-refers-to"), "digest": digest, "segment": segment, "total": total, "block": block,
        "payload": payload if with_payload else None, "payload_bytes": None if payload is None else len(payload),
        "payload_digest": found, "complete": payload is not None and digest in (None, found)}


def _parsed(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = io.BytesIO(content.as_buffer())
                stream = gzip.GzipFile(fileobj=data) if data.getvalue()[:2] == b"\x1f\x8b" else data
                rows, size = [], 0
                for fields, block in read_records(io.BufferedReader(stream) if stream is not data else stream):
                    number = fields.get("warc-segment-number")
                    if number:
                        total = fields.get("warc-segment-total-length")
                        rows.append(_row(fields, block, None, with_payload, int(number), int(total) if total else None))
                    elif fields.get("warc-type") == "revisit":
                        rows.append(_row(fields, None, None, with_payload))
                    else:
                        rows.append(_row(fields, None, payload_of(block), with_payload))
                    size += len(block)
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)

    return run


def _joined(with_payload: bool):
    """Segments sorted by record and number to whole records; equal copies of a record give a row each."""
    def whole(parts: list[dict]) -> list[dict]:
        first, numbers = parts[0], {}
        for p in parts:
            numbers.setdefault(p["segment"], p)
        copies = max(1, sum(p["segment"] == 1 for p in parts))
        block = b"".join(p["block"] for p in numbers.values())
        total = next((p["total"] for p in parts if p["total"] is not None), None)
        good = list(numbers) == list(range(1, len(numbers) + 1)) and total == len(block)
        fields = {"warc-record-id": first["record_id"], "warc-type": "response", "warc-target-uri": first["url"],
                  "x-page-id": None if first["page_id"] is None else str(first["page_id"]),
                  "warc-payload-digest": first["digest"]}
        return [_row(fields, None, payload_of(block) if good else None, with_payload)] * copies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and r["record_id"] != held[0]["record_id"]:
                    yield pa.RecordBatch.from_pylist(whole(held), schema=_PARSED)
                    held = []
                held.append(r)
        if held:
            yield pa.RecordBatch.from_pylist(whole(held), schema=_PARSED)

    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``, continuation records put together with their first.

    Segments are grouped by the first record's id and sorted by number; ``complete``
    tells that the numbers have no gap, the length is the total that the last one
    states, the chunked framing could be decoded, and the digest is right. An
    incomplete payload is null. Only records in several segments are shuffled, and
    a task holds one of them at a time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    parsed = files.mapInArrow(_parsed(with_payload), _PARSED_DDL)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parsed.where("segment is not null").repartition(tasks, "record_id").sortWithinPartitions("record_id", "segment")
    return parsed.where("segment is null").unionByName(parts.mapInArrow(_joined(with_payload), _PARSED_DDL)).drop(
        "block", "segment", "total")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, complete) of every page record.

    A revisit takes length and digest from the response that it names.
    """
    records = Kept(read_warc(spark, path, with_payload=False).drop("payload"), "warc-records").rows
    responses = records.where("record_type <> 'revisit'")
    origins = Kept(responses.where("record_id is not null").groupBy(F.col("record_id").alias("refers_id")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes"),
        F.first("payload_digest").alias("payload_digest")), "warc-origins").rows
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "url", "refers_id", "digest").join(
        origins, "refers_id", "left")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "url", "complete"
    ).unionByName(revisits.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url",
        F.coalesce(F.col("payload_digest") == F.col("digest"), F.lit(False)).alias("complete")))
