"""Operator 5: WARC writing and a salvage reader.

Writing: one record per row. Of the rows with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest id becomes a ``response``, the
others are ``revisit`` records that refer to it and hold no payload. Records
leave through Spark's text writer (a record with a UTF-8 payload is text), so
files appear in shared storage by Spark's commit protocol, also after task
retries. An archive holds at most ``RECORDS_PER_FILE`` records and
``ARCHIVE_BYTES`` bytes, or one record that is longer: records are written by
levels of length, each with its own ``maxRecordsPerFile``, so nothing is shuffled.

Reading: each archive (plain records, gzip members, or a mix) is parsed from
its start. A record or member must pass its checks: version line, header
block, Content-Length, trailing blank line, block and payload digests, gzip
checksum. Where a check fails the reader searches for the next version line or
member magic from which a record does pass, goes on there, and logs the bytes
in between as a quarantined gap with the reason of the first failure. An
archive is read by one task and must fit in its memory (2 GB at most). A
header block may have any length.

Defined results: a null payload is the empty payload; a null id is written as
``<urn:page:null>`` and comes back null, and is never the record that others
refer to; rows that repeat the smallest id are all responses; CR and LF in a
URL are percent-encoded; a null URL has no target header; extra columns are
ignored; an empty table gives archives without records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from .frames import materialize, scratch_path

MIN_REVISIT = 100
RECORDS_PER_FILE = 10_000
ARCHIVE_BYTES = 128 << 20
SCHEMA = ("archive string, start long, past long, kind string, reason string, record_type string, page_id long, url string, "
          "refers_to long, payload_digest string, payload_bytes long, payload binary")
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"


def classified(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(page_id, url, body, size, digest, refers_to): refers_to is null for a response."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("size", F.octet_length("body").cast("long")).withColumn("digest", F.sha2("body", 256))
    first = (rows.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    # bodies stay where they are while the repeated digests are few; past the bound both sides are shuffled
    return join_bounded(rows, materialize(first, "warc_first"), "digest", "left").withColumn(
        "refers_to", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def record_text() -> F.Column:
    """The record of a ``classified`` row without its last line feed."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"),
                    F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(F.col("refers_to").isNull(), F.col("body")).otherwise(F.lit("")))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\nWARC-Record-ID: "), urn("page_id"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), target), F.lit("")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn("refers_to"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nWARC-Block-Digest: sha256:"), F.sha2(block, 256),
        F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r"))


def length_level(size: F.Column, url: F.Column) -> F.Column:
    """0 where ``RECORDS_PER_FILE`` such records fit in an archive, one more for each four times that length."""
    most = size + 3 * F.coalesce(F.octet_length(url), F.lit(0)).cast("long") + 1024
    level = F.lit(0)
    for k in range(10):
        level = level + (most > (ARCHIVE_BYTES << 2 * k) // RECORDS_PER_FILE).cast("int")
    return level


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> str:
    """Write one record per row of ``pages`` below ``path`` (shared storage); returns the path."""
    size = F.octet_length(F.coalesce(F.col(payload).cast("string"), F.lit(""))).cast("long")
    levels = sorted(r[0] for r in pages.select(length_level(size, F.col(url))).distinct().collect()) or [0]
    rows = classified(pages, page_id, url, payload)
    for level in levels:
        part = rows.where(length_level(F.col("size"), F.col("url")) == level) if len(levels) > 1 else rows
        (part.select(record_text().alias("value")).write.mode("overwrite" if level == levels[0] else "append")
         .option("lineSep", "\n").option("maxRecordsPerFile", max(1, RECORDS_PER_FILE >> 2 * level)).text(path))
    return path


class Damage(ValueError):
    """A check of a record or member failed."""


def _header(line: bytes) -> tuple[str, str]:
    name, colon, value = line.partition(b":")
    if not colon:
        raise Damage("header line without a colon")
    return name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace")


def _headers(block: bytes) -> dict[str, str]:
    return dict(_header(line) for line in block.split(b"\r\n"))


def _header_block(b: bytes, at: int) -> tuple[dict[str, str], int]:
    """The header lines from ``at`` to the blank line, and the position behind it; ends at the first line that is none."""
    out = {}
    while (end := b.find(b"\r\n", at)) != at:
        if end < 0:
            raise Damage("headers without an end")
        name, value = _header(b[at:end])
        out[name], at = value, end + 2
    return out, at + 2


def _length(text: str | None, what: str) -> int:
    if text is None or not re.fullmatch(r"\d{1,15}", text):
        raise Damage(f"no valid {what}")
    return int(text)


def _digest_ok(want: str | None, data: bytes) -> bool:
    algorithm, _, value = (want or "").partition(":")
    return algorithm.lower() not in ("sha256", "sha1") or hashlib.new(algorithm.lower(), data).hexdigest() == value.lower()


def _urn(text: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(m[1]) if m else None


def parse_record(b: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the position behind it; ``Damage`` when a check fails."""
    line = b.find(b"\r\n", at, at + 16)
    if not re.fullmatch(rb"WARC/\d\.\d", b[at:line] if line > 0 else b""):
        raise Damage("no version line")
    h, body = _header_block(b, line + 2)
    n = _length(h.get("content-length"), "Content-Length")
    block, past = b[body:body + n], body + n + 4
    if len(block) < n:
        raise Damage("truncated block")
    if b[past - 4:past] != b"\r\n\r\n":
        raise Damage("no blank line behind the block")
    if not _digest_ok(h.get("warc-block-digest"), block):
        raise Damage("block digest differs")
    kind, payload, full = h.get("warc-type", ""), block, None
    if h.get("content-type", "").startswith("application/http"):
        head, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Damage("HTTP headers without an end")
        got = _headers(head.partition(b"\r\n")[2]).get("content-length")
        full = int(got) if got and got.isdigit() else None
    want = h.get("warc-payload-digest")
    if kind != "revisit" and not _digest_ok(want, payload):
        raise Damage("payload digest differs")
    return {"record_type": kind, "page_id": _urn(h.get("warc-record-id")), "url": h.get("warc-target-uri"),
            "refers_to": _urn(h.get("warc-refers-to")), "payload_digest": (want or "").partition(":")[2] or None,
            "payload_bytes": (full if kind == "revisit" else len(payload)), "payload": None if kind == "revisit" else payload}, past


def _member(b: bytes, at: int) -> tuple[list[dict], int]:
    """All records of the gzip member at ``at`` and the position behind the member."""
    z, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not z.eof and fed < len(b):
            parts.append(z.decompress(b[fed:fed + 65536]))
            fed = min(len(b), fed + 65536)
    except zlib.error as e:
        raise Damage(f"gzip: {e}") from None
    if not z.eof:
        raise Damage("truncated gzip member")
    data = b"".join(parts)
    out, pos = [], 0
    while pos < len(data):
        record, pos = parse_record(data, pos)
        out.append(record)
    return out, fed - len(z.unused_data)


def salvage(b: bytes) -> Iterator[dict]:
    """Records and gaps of one archive, in order; start and past are positions in the archive.

    Every byte belongs to exactly one record, member or gap.
    """
    at, gap, why = 0, -1, ""
    while at < len(b):
        try:
            records, past = _member(b, at) if b[at:at + 3] == MAGIC else (lambda r: ([r[0]], r[1]))(parse_record(b, at))
        except Damage as e:
            if gap < 0:
                gap, why = at, str(e)
            ahead = [x for x in (b.find(b"WARC/", at + 1), b.find(MAGIC, at + 1)) if x >= 0]
            at = min(ahead, default=len(b))
            continue
        if gap >= 0:
            yield {"kind": "gap", "reason": why, "start": gap, "past": at}
            gap = -1
        for r in records:
            yield r | {"kind": "record", "start": at, "past": past}
        at = past
    if gap >= 0:
        yield {"kind": "gap", "reason": why, "start": gap, "past": len(b)}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``SCHEMA``: the records and the quarantined gaps of all archives below ``path``."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in SCHEMA.split(", ")]

    def out(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)

    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for r in salvage(content.as_py()):
                    rows.append(r | {"archive": archive.as_py()})
                    held += len(r.get("payload") or b"") + len(r.get("url") or "") + 200
                    if held > 4 << 20:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` into archives below ``path`` (default: the shared scratch folder) and read them back."""
    spark = pages.sparkSession
    return read_archives(spark, write_archives(pages, path or scratch_path(spark, "warc"), **columns))
