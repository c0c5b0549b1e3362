"""WARC archives: written with revisits for repeated payloads, read back by a salvaging reader."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedmark.llm.common import table
from feedmark.session import new_folder, stage

LEAST = 100  # bytes of a payload that may be revisited
RECORDS = 2000  # in a file
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
CHECK = b"\r\nX-Header-CRC32: "  # of the headers before it
EMPTY = zlib.compress(b"", wbits=31)
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[0-9]\r\n")
CUT = "member is cut off"
_CHUNK = 1 << 16


def record_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages`` as page_id, url, payload, payload_bytes, payload_digest, refers_to (null for a response).

    Equal payloads are found from digests and sizes, so the pages move once, to be written.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", F.sha2("payload", 256))
    keys = ["payload_digest", "payload_bytes"]
    groups = rows.where(F.col("payload_bytes") >= least).groupBy(*keys).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(groups.where("n > 1").drop("n"), keys, "left")
    later = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.withColumn("refers_to", F.when(later, F.col("first"))).drop("first")


def write(pages: DataFrame, folder: str, least: int = LEAST, records: int = RECORDS) -> None:
    """One record for each row, each a gzip member, in WARC files of ``folder``.

    Spark's text writer moves the bytes, so its committer sees to lost tasks. It ends each row with
    a zero byte, which is the last one of a member below 16 MB; a longer one is followed by an empty member.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    again = F.col("refers_to").isNotNull()
    block = F.when(again, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(again, line("WARC-Refers-To", urn("refers_to"))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    check = F.concat(F.lit(CHECK[2:].decode()), F.crc32(head.cast("binary")).cast("string"), F.lit(END.decode()))
    record = F.concat(head, check, block, F.lit(END.decode()))
    rows = record_types(pages, least).select(record.alias("value")).mapInArrow(_zipped, "value binary")
    out = rows.select(F.col("value").cast("string")).write
    out.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", records).text(folder)


def _zipped(batches):
    """A member for each record, without the zero byte at its end."""
    for batch in batches:
        members = [zlib.compress(value.as_buffer(), wbits=31) for value in batch.column("value")]
        members = [m[:-1] if not m[-1] else m + EMPTY[:-1] for m in members]
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes


@dataclass
class Gap:
    """Bytes that belong to no record read: ``length`` from ``offset``, inside the member at ``member`` if that is not None."""

    offset: int
    length: int
    reason: str
    member: int | None = None
    found: list = field(default_factory=list, repr=False)


def _up_to_fault(unzip, chunk: memoryview) -> tuple[bytes, int]:
    """What comes out of a chunk before it fails, and at which byte: by ever smaller steps, at last byte by byte both ways."""
    out, passed = [], 0
    for step in (4096, 64, 1):
        at = 0
        while True:
            before = unzip.copy()
            try:
                out.append(unzip.decompress(chunk[at : at + step]))
            except zlib.error:
                unzip, chunk = before, chunk[at : at + step]
                break
            at += step
        passed += at
    try:
        some = unzip.decompress(chunk, 1)
        while some:
            out.append(some)
            some = unzip.decompress(unzip.unconsumed_tail, 1)
    except zlib.error:
        pass
    return b"".join(out), passed


def _member(raw: memoryview, at: int) -> tuple[bytes, int, str]:
    """What the member at ``at`` holds, where it ends, and what is wrong with it."""
    unzip, out = zlib.decompressobj(31), []
    while at < len(raw) and not unzip.eof:
        chunk = raw[at : at + _CHUNK]
        before = unzip.copy()
        try:
            out.append(unzip.decompress(chunk))
        except zlib.error as error:
            rest, passed = _up_to_fault(before, chunk)
            return b"".join(out) + rest, at + passed, str(error)
        at += len(chunk) - len(unzip.unused_data)
    return b"".join(out), at, "" if unzip.eof else CUT


def _valid(view: memoryview, at: int) -> bool:
    """Whether a member that begins with a version line, or that passes its checks, begins at ``at``."""
    start, _, fault = _member(view[: at + _CHUNK], at)
    if not fault or VERSION.match(start):
        return True
    return fault == CUT and at + _CHUNK < len(view) and not _member(view, at)[2]


def _next_member(raw: bytes, at: int) -> int:
    view = memoryview(raw)
    while (at := raw.find(MEMBER, at)) >= 0 and not _valid(view, at):
        at += 1
    return at if at >= 0 else len(raw)


def _next_record(raw: bytes, at: int, stop: int) -> int:
    for found in VERSION.finditer(raw, at, stop):
        if isinstance(_record(raw, found.start()), tuple):
            return found.start()
    return stop


def salvage(raw: bytes) -> Iterator[Record | Gap]:
    """Records and gaps of an archive, gzipped by member or as a whole, or plain, in order.

    A member or record that fails a check is followed by a search for the next valid member and the
    next version line of a whole record, wherever the archive began; the first of them is taken.
    Records before the fault in a damaged member are kept if they are whole and pass their own
    checks: the digest of the payload, and that of the headers in the archives written here.
    """
    view, at, member = memoryview(raw), 0, -1
    while at < len(raw):
        end = at
        if raw.startswith(MEMBER, at):
            data, fails, fault = _member(view, at)
            if not fault:
                yield from _records(data, at)
                at = fails
                continue
            for got in _records(data, at, cut=True):
                end = fails if isinstance(got, Record) else end
                yield got
        else:
            got = _record(raw, at)
            if isinstance(got, tuple):
                record, at = got
                yield record
                continue
            fault = got
        if member <= at:
            member = _next_member(raw, at + 1)  # it may stand before the place that failed
        stop = _next_record(raw, end + 1, member)
        end = min(end, stop)
        yield Gap(end, stop - end, fault)
        at = stop


def _records(data: bytes, member: int | None, cut: bool = False) -> Iterator[Record | Gap]:
    at = 0
    while at < len(data):
        got = _record(data, at)
        if isinstance(got, tuple):
            record, at = got
            yield record
            continue
        following = VERSION.search(data, at + 1)
        while following and not isinstance(_record(data, following.start()), tuple):
            following = VERSION.search(data, following.start() + 1)
        stop = following.start() if following else len(data)
        if not cut or following:
            yield Gap(at, stop - at, got, member)
        at = stop


def _record(data: bytes, at: int) -> tuple[Record, int] | str:
    if not VERSION.match(data, at):
        return "no version line"
    body = data.find(END, at)
    if body < 0:
        return "headers do not end"
    lines = data[at:body].decode("utf-8", "replace").split("\r\n")[1:]
    if any(":" not in x and x[:1] not in " \t" for x in lines):
        return "damaged headers"
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    start = body + len(END)
    end = start + int(length)
    if data[end : end + len(END)] != END:
        return "block does not end where it should"
    block = data[start:end]
    check = data.find(CHECK, at, body)
    if check >= 0 and headers[CHECK[2:-2].decode().lower()] != str(zlib.crc32(data[at : check + 2])):
        return "header check differs"
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
        return "payload digest differs"
    return Record(at, headers, block), end + len(END)


SCHEMA = (
    "path string, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint,"
    " payload binary, gap_offset bigint, gap_length bigint, gap_member bigint, gap_reason string"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(",")]


def read(spark, folder: str, payloads: bool = True) -> DataFrame:
    """Rows of records and of gaps (gap_reason is not null) of every archive in ``folder``."""

    def number(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if re.fullmatch(r"-?[0-9]+", digits) else None

    def row(path: str, got: Record | Gap) -> tuple:
        if isinstance(got, Gap):
            return (path, *[None] * 7, got.offset, got.length, got.member, got.reason)
        h = got.headers
        digest = h.get("warc-payload-digest", "").removeprefix("sha256:") or hashlib.sha256(got.block).hexdigest()
        size = int(h["x-payload-length"]) if h.get("x-payload-length", "").isdigit() else len(got.block)
        revisit = h.get("warc-type") == "revisit"
        refers = number(h.get("warc-refers-to")) if revisit else None
        block = got.block if payloads and not revisit else None
        return (path, number(h.get("warc-record-id")), h.get("warc-target-uri"), h.get("warc-type"), size, digest, refers, block, *[None] * 4)

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for got in salvage(content.as_py()):
                    rows.append(row(path.as_py(), got))
                    held += len(rows[-1][7] or b"")
                    if len(rows) >= 4096 or held > 16 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of archives written to the shared folder and read back.

    ``records``: page_id, payload_bytes, payload_digest, record_type, refers_to, one row per row of
    ``pages`` (page_id, url, html; other columns are ignored). A null html is an empty payload, a
    null url has no header, a record with a null page_id never is the one revisited, and rows that
    repeat the smallest page_id of a group are responses all. An empty table gives no rows.
    """
    folder = new_folder(pages.sparkSession, "warc")
    write(pages, folder, least)
    rows = stage(read(pages.sparkSession, folder, payloads=False).drop("payload"), "records")
    records = rows.where("gap_reason is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    gaps = rows.where("gap_reason is not null").select("path", "gap_offset", "gap_length", "gap_member", "gap_reason")
    return records, gaps


def query(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages"))[0]


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (SELECT page_id, cast(strlen(t) AS BIGINT) AS payload_bytes, sha256(t) AS payload_digest, min(page_id) OVER (PARTITION BY t) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM q
"""
