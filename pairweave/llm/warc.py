"""WARC archives: pages are written as records and read back, segmented records are put together again.

Writing: the first of equal payloads (by SHA-1) is a ``response`` record with a chunked HTTP message, the others are
``revisit`` records that refer to it and hold no payload. A block above ``segment_bytes`` is cut: the first record has
segment number 1, ``continuation`` records name it as their origin, and the last one states the total length. Records go
through Spark's text sink with the record separator as line separator, ``file_records`` records a file at most, so
executors write to any store that Spark reaches. All cuts fall between characters, so a record is valid UTF-8.

Reading: files are parsed record by record by ``Content-Length``. Continuation records are grouped by origin identifier
and ordered by segment number; numbers must run from 1 without a gap, and the total length must fit; then the HTTP message
is split and its chunked framing decoded. Complete records are decoded where they are read; only segments are shuffled.

Defined cases: a null html is an empty payload. Of equal payloads the smallest page id is the response (nulls last); rows
alike in id and payload give one response and revisits that refer to the same id. Null ids and null urls are left out of
the record and read back as null. Blanks and control characters in a url are percent-encoded. A record whose segments are
incomplete, whose framing is broken or whose payload has another digest than it states is read with ``valid`` false and
null payload fields. Empty tables give an archive without records. Only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairweave.session import rewrite

#: About the most bytes of records in a file, and the most that a task holds before it passes them on.
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
_END = b"\r\n\r\n"
_PAYLOADS = "page_id bigint, url string, html string, payload_bytes bigint, payload_digest string"
_READ = "record_id string, record_type string, page_id bigint, refers_to_record string, payload_bytes bigint, payload_digest string, valid boolean"
_SEGMENTS = "origin string, number int, total bigint, head binary, block binary"


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1, as archives state it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16], version=5)}>"


def _cuts(data: bytes, size: int) -> list[bytes]:
    """Pieces of at most ``size`` bytes (four at least) that end between characters."""
    pieces, low = [], 0
    while low < len(data):
        high = min(len(data), low + size)
        while high < len(data) and data[high] & 0xC0 == 0x80:
            high -= 1
        pieces.append(data[low:high])
        low = high
    return pieces


def chunked(payload: bytes, size: int = 4096) -> bytes:
    """Chunked transfer framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in _cuts(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload inside chunked framing; extensions and trailers are skipped. Raises ``ValueError`` where it is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if size < 0 or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, found, body = block.partition(_END)
    if not found:
        raise ValueError("no end of the HTTP header")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + _END + block


def _records_of(row: dict, segment_bytes: int, date: str) -> Iterator[bytes]:
    url = row["url"] and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
    digest = row["payload_digest"]
    origin = _record_id("response", digest)
    common = [("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", row["page_id"])]
    kind = ("Content-Type", "application/http;msgtype=response")
    if row["record_type"] == "revisit":
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", _record_id(row["page_id"], digest, row["copy"])), *common, kind]
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([*fields, ("WARC-Refers-To", origin), ("WARC-Profile", profile)], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = message + chunked((row["html"] or "").encode())
    segments = _cuts(block, segment_bytes)
    for number, segment in enumerate(segments, 1):
        place = [("WARC-Segment-Number", number)] if len(segments) > 1 else []
        if number == 1:
            yield _record([("WARC-Type", "response"), ("WARC-Record-ID", origin), *common, kind, *place], segment)
        else:
            place += [("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Total-Length", len(block) if number == len(segments) else None)]
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", _record_id(origin, number)), ("WARC-Date", date), *place], segment)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [(h or "").encode() for h in batch.column(2).to_pylist()]
        sizes, digests = pa.array(map(len, raw), pa.int64()), pa.array(map(payload_digest, raw), pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, sizes, digests], names=["page_id", "url", "html", "payload_bytes", "payload_digest"])


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, segment_bytes: int = 32_768, file_records: int = 1_000, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write ``pages`` (``page_id, url, html``) as archives below ``path``. Payloads under ``least_bytes`` are never revisits.

    Who responds is found among ids and digests; then each page moves once, by id and digest, so that a payload which a
    third of all pages share is spread over all tasks.
    """
    rows = pages.select("page_id", "url", "html").mapInArrow(_payloads, _PAYLOADS)
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id")
    first = rows.select("page_id", "payload_digest").groupBy("payload_digest").agg(F.min(order).alias("f"))
    # One key for the join and for numbering copies, so that a page is shuffled once.
    key = lambda page: F.concat_ws(":", "payload_digest", page)
    first = first.select(key(F.col("f.page_id")).alias("key"), F.lit(True).alias("is_first"))
    placed = rows.withColumn("key", key(F.col("page_id"))).join(first.hint("merge"), "key", "left")
    placed = placed.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("url")).cast("int"))
    response = (F.col("is_first").isNotNull() & (F.col("copy") == 1)) | (F.col("payload_bytes") < least_bytes)
    kind = F.when(response, "response").otherwise("revisit")
    ready = placed.select("page_id", "url", "payload_digest", "copy", kind.alias("record_type"), F.when(response, F.col("html")).alias("html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[bytes] = []
            size = 0
            for i in range(len(batch)):
                for record in _records_of(batch.slice(i, 1).to_pylist()[0], segment_bytes, date):
                    held.append(record)
                    size += len(record)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["record"])
                        held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["record"])

    records = ready.mapInArrow(write, "record binary").select(F.col("record").cast("string").alias("value"))
    # A record is a segment and a header, so this bounds the bytes of a file, which is read as one value.
    file_records = max(1, min(file_records, FILE_BYTES // segment_bytes))
    options = {"lineSep": _END.decode(), "compression": "gzip", "maxRecordsPerFile": file_records}
    records.write.options(**options).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields in lower case, block)`` of each record of an uncompressed archive."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        head_end = data.index(_END, start)
        lines = data[start:head_end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        begin = head_end + len(_END)
        at = begin + int(fields["content-length"])
        yield fields, data[begin:at]


def _read_row(fields: dict[str, str], payload: bytes | None) -> tuple:
    """A row of ``_READ``; ``payload`` is None where it could not be put together, and not looked at for revisits."""
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    page = fields.get("x-page-id")
    known = (fields.get("warc-record-id"), fields.get("warc-type"), int(page) if page else None, fields.get("warc-refers-to"))
    if fields.get("warc-type") == "revisit":
        return (*known, None, stated, stated is not None)
    digest = None if payload is None else payload_digest(payload)
    fits = digest is not None and stated in (None, digest)
    return (*known, len(payload) if fits else None, digest if fits else None, fits)


def _decoded(fields: dict[str, str], block: bytes | None) -> tuple:
    try:
        return _read_row(fields, None if block is None or fields.get("warc-type") == "revisit" else http_payload(block))
    except ValueError:
        return _read_row(fields, None)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_pydict({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(columns)})


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple[dict[str, str], bytes]]]:
    for batch in batches:
        for content in batch.column(0):
            data = content.as_py()
            yield parse_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)


def _complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for records in _archives(batches):
        yield _batch([_decoded(f, b) for f, b in records if "warc-segment-number" not in f and f.get("warc-type") in ("response", "revisit")], _READ)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for records in _archives(batches):
        rows = []
        for f, block in records:
            if "warc-segment-number" in f:
                first = f.get("warc-type") != "continuation"
                total = f.get("warc-segment-total-length")
                head = "\n".join(f"{k}:{v}" for k, v in f.items()).encode() if first else None
                origin = f.get("warc-record-id" if first else "warc-segment-origin-id")
                rows.append((origin, int(f["warc-segment-number"]), int(total) if total else None, head, block))
        yield _batch(rows, _SEGMENTS)


def reassemble(numbers: list[int], totals: list[int | None], blocks: list[bytes]) -> bytes | None:
    """The block of segments in any order; None if one is missing or repeated, or the length is not the stated one."""
    order = sorted(range(len(numbers)), key=lambda i: numbers[i])
    total = [totals[i] for i in order if totals[i] is not None]
    block = b"".join(blocks[i] for i in order)
    complete = [numbers[i] for i in order] == list(range(1, len(numbers) + 1)) and total == [len(block)]
    return block if complete else None


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 64):
            rows = []
            for segments in batch.slice(low, 64).column(0).to_pylist():
                heads = [s["head"] for s in segments if s["head"] is not None]
                fields = dict(line.split(":", 1) for line in heads[0].decode().split("\n")) if heads else {"warc-type": "response"}
                rows.append(_decoded(fields, reassemble([s["number"] for s in segments], [s["total"] for s in segments], [s["block"] for s in segments])))
            yield _batch(rows, _READ)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record below ``path``.

    ``record_id, record_type, page_id, payload_bytes, payload_digest, valid, refers_to`` (page id of the response). A
    revisit takes its size from the response it refers to, and is valid only if that exists and has the stated digest.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    segments = files.mapInArrow(_segments, _SEGMENTS).groupBy("origin")
    grouped = segments.agg(F.collect_list(F.struct("number", "total", "head", "block")).alias("segments")).select("segments")
    records, _ = rewrite(files.mapInArrow(_complete, _READ).unionByName(grouped.mapInArrow(_joined, _READ)), "records")
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("origin"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("origin_bytes"), F.col("payload_digest").alias("origin_digest")
    )
    revisits = records.filter("record_type = 'revisit'").join(responses, F.col("refers_to_record") == F.col("origin"), "left")
    fits = F.coalesce(F.col("valid") & (F.col("payload_digest") == F.col("origin_digest")), F.lit(False))
    whole = ["record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "valid", "refers_to"]
    resolved = revisits.withColumns({"payload_bytes": F.when(fits, F.col("origin_bytes")), "payload_digest": F.when(fits, F.col("payload_digest")), "valid": fits})
    plain = records.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint"))
    return plain.select(whole).unionByName(resolved.select(whole))
