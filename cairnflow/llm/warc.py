"""Web archives: pages written as WARC 1.1 records, and archives read back with their segments put together.

Writing. Equal payloads are found on digests alone; of each payload the record
with the smallest page_id is a ``response`` and the others are ``revisit``
records without a body. A response is an HTTP message in chunked transfer
framing; a message longer than ``segment_bytes`` is cut into a first segment and
``continuation`` records. Every record is a gzip member of its own. Tasks fill
archives of about ``archive_bytes``, and Spark's own writer commits them, one
file each, so a lost executor or a repeated task leaves no torn file.

Reading. Files are parsed record by record. Whole records are decoded where
they are read; segments are grouped by the identifier of their origin, ordered
by number, checked for gaps and against the total length, joined, and then
decoded like the others. A group is one message, no longer than the page it came
from. Revisits take their payload's length from the response with their digest;
payloads that very many revisits share are looked up by a broadcast of fewer
than 1,024 rows, the others by a join.

What cannot be read comes back with a ``status`` and without a payload:
``malformed``, ``truncated`` (file ends inside a record), ``missing segment``,
``conflicting segments``, ``wrong length`` (total), ``bad chunk``, ``short body``,
``wrong digest``, ``unresolved`` (a revisit without its response).

Edge cases: null html is an empty payload; a null url gives a record without
target; a null page_id is written as a response and takes no part in the search
for equal payloads; rows repeating page_id and payload have the same type; one
page_id with different payloads has a record for each; control characters and
spaces of a url are percent-encoded; texts are written whole, however long; other
columns may have any names; an empty table gives an archive without records.
Files of others may be plain or gzipped, record by record or as a whole; each is
held in memory, at most ``archive_bytes`` and one record for those written here.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batches, bound_batches, hot_join

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_END = b"\r\n\r\n"


# --- records as bytes ---


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), chunk_bytes):
        piece = payload[at : at + chunk_bytes]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; extensions and trailers are skipped, None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";", 1)[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(parts) if body[at : at + 2] == b"\r\n" or body.find(_END, at) >= 0 else None
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        parts.append(body[at : at + n])
        at += n + 2


def http_payload(message: bytes) -> tuple[str, bytes | None]:
    """(status, payload) of an HTTP response."""
    head, gap, body = message.partition(_END)
    if not gap:
        return "malformed", None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if b"chunked" in fields.get(b"transfer-encoding", b"").lower():
        payload = dechunked(body)
        return ("ok", payload) if payload is not None else ("bad chunk", None)
    length = fields.get(b"content-length", b"")
    if length.isdigit() and int(length) != len(body):
        return "short body", None
    return "ok", body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One gzip member; fields without a value are left out."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + _END) + packer.flush()


def page_records(page: dict, ident: Iterator[str], date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    target = page["url"] and re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", page["url"])
    digest = f"sha256:{page['digest']}"
    own = next(ident)
    common = [("WARC-Date", date), ("WARC-Target-URI", target or None), ("Page-ID", page["page_id"])]
    if page["refers_to"] is not None:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", _PROFILE), ("WARC-Payload-Digest", digest), ("Refers-To-Page-ID", page["refers_to"]), ("Content-Type", "application/http; msgtype=response")], _HTTP)
        return
    block = _HTTP + chunked(page["html"], chunk_bytes)
    segmented = len(block) > segment_bytes
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response"), ("WARC-Segment-Number", 1 if segmented else None)]
    yield record(first, block[:segment_bytes] if segmented else block)
    for number, at in enumerate(range(segment_bytes, len(block), segment_bytes) if segmented else (), 2):
        last = at + segment_bytes >= len(block)
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", next(ident)), *common, ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if last else None)]
        yield record(more, block[at : at + segment_bytes])


def unpacked(content: bytes, step: int = 1 << 14) -> Iterator[bytes]:
    """A plain file as it is, a gzipped one member by member; bytes behind the members that are no gzip are left out."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    at, view = 0, memoryview(content)
    while content[at : at + 2] == b"\x1f\x8b":
        member, parts = zlib.decompressobj(31), []
        while not member.eof and at < len(content):
            fed = view[at : at + step]
            try:
                parts.append(member.decompress(fed))
            except zlib.error:
                yield b"".join(parts)
                return
            at += len(fed) - len(member.unused_data)
        yield b"".join(parts)


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes, str]]:
    """(fields in lower case, block, status) of every record of a file. After bytes that are no record the search goes on at the next one."""
    held = b""
    for part in unpacked(content):
        held = held + part if held else part
        at = 0
        while True:
            while held[at : at + 1] in (b"\r", b"\n", b"\0"):
                at += 1
            end = held.find(_END, at)
            if end < 0:
                break
            head = re.sub(rb"\r\n[ \t]+", b" ", held[at:end]).decode("utf-8", "replace").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, gap, v in (x.partition(":") for x in head[1:]) if gap}
            length = fields.get("content-length", "")
            if not head[0].startswith("WARC/") or not length.isdecimal():
                yield {}, b"", "malformed"
                after = held.find(b"\r\n\r\nWARC/", at)
                at = after + 4 if after >= 0 else len(held)
                continue
            stop = end + 4 + int(length)
            if stop > len(held):
                break
            yield fields, held[end + 4 : stop], "ok"
            at = stop
        held = held[at:]
    if held.strip(b"\r\n\0"):
        yield {}, held, "truncated"


# --- writing ---


def revisits(pages: DataFrame, scratch: Scratch, min_bytes: int = 100) -> DataFrame:
    """(page_id, digest, refers_to) of the records whose payload of at least ``min_bytes`` a smaller page_id has too. pages: page_id, digest, bytes."""
    sums = scratch.save(pages.where(F.col("page_id").isNotNull() & (F.col("bytes") >= min_bytes)).select("page_id", "digest"), "sums")
    shared = sums.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").drop("last")
    met = hot_join(sums, scratch.save(shared, "shared"), "digest").where("page_id > refers_to")
    return scratch.save(met.distinct(), "revisits")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 100, segment_bytes: int = 1 << 15, chunk_bytes: int = 1 << 13, archive_bytes: int = 1 << 25, date: str | None = None) -> None:
    """Writes the pages as gzipped WARC files under ``path``: payloads of at least ``min_bytes`` once, messages of over ``segment_bytes`` in segments."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    when, run = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), uuid.uuid4().hex
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("html"))
    own = own.withColumn("digest", F.sha2("html", 256))
    again = revisits(own.withColumn("bytes", F.octet_length("html")), scratch, min_bytes)
    known = own.where("page_id is not null").join(again.hint("shuffle_hash"), ["page_id", "digest"], "left")
    marked = known.unionByName(own.where("page_id is null").withColumn("refers_to", F.lit(None).cast("long")))

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ident = (f"<urn:uuid:{uuid.UUID(bytes=hashlib.blake2b(f'{run}:{task}:{n}'.encode(), digest_size=16).digest())}>" for n in range(1 << 62))
        archive, size = [], 0
        for part in batches(rows):
            names = list(part)
            for values in zip(*part.values(), strict=True):
                for one in page_records(dict(zip(names, values, strict=True)), ident, when, segment_bytes, chunk_bytes):
                    archive.append(one)
                    size += len(one)
                    if size >= archive_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(archive)], pa.binary())], names=["body"])
                        archive, size = [], 0
        if archive:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(archive)], pa.binary())], names=["body"])

    bodies = marked.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "digest", "refers_to").mapInArrow(pack, "body binary")
    # one archive a file; the zero byte behind it is padding that readers of gzip files skip
    bodies.select(F.col("body").cast("string")).write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\0").text(path)
    scratch.drop("sums", "shared", "revisits")


# --- reading ---

_SCHEMA = "record_id string, kind string, page_id long, url string, refers_to long, claimed string, number int, total long, block binary, status string, payload_bytes long, payload_digest string, payload binary"
_CARRIED = ["record_id", "kind", "page_id", "url", "refers_to", "claimed"]


def _whole(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def _decoded(kind: str, block: bytes, status: str, claimed: str | None, keep: bool) -> tuple:
    """(status, payload_bytes, payload_digest, payload) of a whole message."""
    payload = None
    if status == "ok" and kind != "revisit":
        status, payload = http_payload(block) if kind == "response" else ("ok", block)
    digest = payload is not None and hashlib.sha256(payload).hexdigest()
    if digest and claimed and claimed.lower().startswith("sha256:") and claimed[7:].lower() != digest:
        status, payload = "wrong digest", None
    if payload is None:
        return status, None, None, None
    return status, len(payload), digest, payload if keep else None


def joined_segments(parts: list[dict]) -> tuple[str, bytes]:
    """(status, message) of the segments of one record, in the order of their numbers; segments that are there twice count once."""
    by_number: dict[int, bytes] = {}
    totals = {p["total"] for p in parts if p["total"] is not None}
    for p in parts:
        if by_number.setdefault(p["number"], p["block"]) != p["block"]:
            return "conflicting segments", b""
    numbers = sorted(by_number)
    if numbers != list(range(1, len(numbers) + 1)) or not totals:
        return "missing segment", b""
    message = b"".join(by_number[n] for n in numbers)
    return ("ok" if totals == {len(message)} else "wrong length"), message


def read_archive(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """(record_id, kind, page_id, url, refers_to, status, payload_bytes, payload_digest[, payload]) of the response, resource, conversion and revisit records under ``path``."""
    scratch = Scratch(spark, "warc-read")
    bound_batches(spark)
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}.get(x.split()[1], pa.string())) for n, x in zip(names, _SCHEMA.split(", "), strict=True)])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def scan(content: bytes) -> Iterator[tuple]:
        for fields, block, status in records(content):
            kind, number = fields.get("warc-type", ""), _whole(fields.get("warc-segment-number"))
            if status == "ok" and kind not in ("response", "resource", "conversion", "revisit", "continuation"):
                continue
            own = fields.get("warc-record-id")
            origin = fields.get("warc-segment-origin-id", own) if number is not None else own
            head = (origin, kind, _whole(fields.get("page-id")), fields.get("warc-target-uri"), _whole(fields.get("refers-to-page-id")), fields.get("warc-payload-digest"))
            if number is None:
                status = "missing segment" if kind == "continuation" else status
                yield (*head, None, None, None, *_decoded(kind, block, status, head[-1], keep_payload))
            else:
                yield (*head, number, _whole(fields.get("warc-segment-total-length")), block, status, None, None, None)

    def parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for content in part.column(0):
                held, size = [], 0
                for row in scan(content.as_py()):
                    held.append(row)
                    size += 500 + len(row[8] or b"") + len(row[12] or b"")
                    if size >= 1 << 23:
                        yield out(held)
                        held, size = [], 0
                if held:
                    yield out(held)

    def assemble(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows):
            for parts in part["parts"]:
                first = next((p for p in parts if p["number"] == 1), parts[0])
                status, message = joined_segments(parts)
                yield out([(*(first[c] for c in _CARRIED), None, None, None, *_decoded(first["kind"], message, status, first["claimed"], keep_payload))])

    files = spark.read.format("binaryFile").load(path).select("content")
    found = scratch.save(files.mapInArrow(parse, _SCHEMA), "records")
    segments = found.where("number is not null").groupBy("record_id").agg(F.collect_list(F.struct(*_CARRIED, "number", "total", "block")).alias("parts"))
    whole = found.where("number is null").unionByName(segments.select("parts").mapInArrow(assemble, _SCHEMA))
    whole = scratch.save(whole.drop("number", "total", "block"), "whole")
    bodies, again = whole.where("kind <> 'revisit'"), whole.where("kind = 'revisit'")
    digest = F.lower(F.regexp_replace("claimed", "^(?i)sha256:", ""))
    payloads = bodies.where("status = 'ok' and kind = 'response'").groupBy(F.col("payload_digest").alias("digest")).agg(F.min("page_id").alias("source"), F.max("payload_bytes").alias("n"))
    met = hot_join(again.withColumn("digest", F.coalesce(digest, F.col("record_id"))), scratch.save(payloads, "payloads"), "digest")
    met = met.withColumns({"status": F.when(F.col("status") != "ok", F.col("status")).when(F.col("n").isNull(), "unresolved").otherwise("ok"), "payload_bytes": F.col("n"), "payload_digest": F.when(F.col("n").isNotNull(), F.col("digest")), "refers_to": F.coalesce("refers_to", "source")})
    kept = ["record_id", "kind", "page_id", "url", "refers_to", "status", "payload_bytes", "payload_digest"] + ["payload"] * keep_payload
    return bodies.select(*kept).unionByName(met.select(*kept))


def archive_digest(pages: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, as read back from archives that are written for it."""
    scratch = Scratch(pages.sparkSession, "warc-digest")
    path = f"{scratch.base}/archives"
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path, keep_payload=False).select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS least FROM p WHERE page_id IS NOT NULL AND strlen(html) >= 100 GROUP BY html)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN p.page_id > f.least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > f.least THEN f.least END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""
