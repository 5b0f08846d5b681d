"""Web archives: a writer with one gzip member per record, and a salvage reader.

Pages with equal payloads are stored once, as a response record; the others become revisit records that refer to it.
The archives are written through Spark's own committer, so retried tasks leave nothing half done, and lie in the shared
folder. Between records stands an empty gzip member, which every gzip reader skips.

The reader checks each record: gzip checksum, version line, header lines, block length and digest. Where a check fails
it searches for the next place that passes all of them (a gzip member or a version line), goes on there, and reports the
bytes between as a quarantined gap. In a member of several records it searches the content likewise and reports gaps at the
member's place, in bytes of the content; of a member that is cut off or broken, the records before the damage whose digests
hold are kept, and the member is a gap.

Defined cases: a null html is an empty payload, a null url an empty address; of repeated rows with one id all are
responses or all revisits; a null page_id is written and read back as null; an empty table gives no records. An archive
file ends at ``FILE_BYTES`` or with the record that reaches them, so a task that reads one holds about that much, or one very
long page. Pages that were archived and read back have all their records, or the query ends with an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators.joins import attach
from cohortlens.sources.scratch import scratch_path

#: Compressed size of an archive file, and of the rows that the writer counts to keep to it.
FILE_BYTES, ROW_BYTES = 32 << 20, 1 << 20
#: Payloads from this size on are stored once.
LEAST_BYTES = 0
#: Fixed values of the format.
VERSION = b"WARC/1.1"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = _member(b"")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit keeps the payload's length and digest but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        lines[2:2] = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", _PROFILE)]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the pages (page_id, url, html) as compressed archives below ``path``."""
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html")
    ).withColumn("digest", F.sha1("html"))
    several = named.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    kept = attach(named, several, ["digest"])
    refers = F.when(F.col("page_id") != F.col("keeper"), F.col("keeper"))
    kept = kept.select("page_id", "url", "html", refers.alias("refers_to"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(parts: list[bytes]) -> pa.RecordBatch:
            # A row for each ROW_BYTES: those after the first of a long member are empty, which writes an empty member more.
            fill = [b""] * (sum(map(len, parts)) // ROW_BYTES)
            return pa.RecordBatch.from_arrays([pa.array([EMPTY_MEMBER.join(parts), *fill], pa.binary())], names=["members"])

        waiting: list[bytes] = []
        size = 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns):
                member = _member(record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py()))
                if waiting and size + len(member) > ROW_BYTES:
                    yield of(waiting)
                    waiting, size = [], 0
                waiting.append(member)
                size += len(member)
        if waiting:
            yield of(waiting)

    # The text writer puts a row's bytes out as they are; Latin-1 maps the separator's characters to its bytes.
    written = kept.mapInArrow(rows, "members binary").select(F.col("members").cast("string").alias("value"))
    written.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").option(
        "maxRecordsPerFile", FILE_BYTES // ROW_BYTES
    ).text(path)


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record that starts at ``at``; None if any check fails."""
    if not _VERSION_LINE.match(data, at):
        return None
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    headers: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        return None
    start = end + 4
    stop = start + int(length)
    block = data[start:stop]
    if data[stop : stop + 4] != b"\r\n\r\n":
        return None
    digest = headers.get("warc-block-digest")
    if digest and digest != f"sha1:{base32_sha1(block)}":
        return None
    return headers, block, stop + 4


def _member_at(data: bytes, at: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip member at ``at``, its checksum verified."""
    unpacker, parts, upto = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof and upto < len(data):
            # Small steps: what follows the member is handed back as a copy.
            parts.append(unpacker.decompress(data[upto : upto + 4096]))
            upto = min(upto + 4096, len(data))
    except zlib.error:
        return None
    return (b"".join(parts), upto - len(unpacker.unused_data)) if unpacker.eof else None


def _broken_member_at(data: bytes, at: int) -> bytes:
    """What can be read of the gzip member at ``at`` before it breaks."""
    parts, step, upto = [], 4096, at
    unpacker = zlib.decompressobj(31)
    while upto < len(data) and not unpacker.eof:
        try:
            # Each large step from a copy, so that one that fails can be taken again byte by byte.
            ahead = unpacker.copy() if step > 1 else unpacker
            parts.append(ahead.decompress(data[upto : upto + step]))
            unpacker, upto = ahead, upto + step
        except zlib.error:
            if step == 1:
                break
            step = 1
    return b"".join(parts)


def _inside(content: bytes, at: int, checked: bool) -> list[tuple[int, dict[str, str] | None, bytes | int]]:
    """The records of a member's content and the gaps between them; ``checked``: only records with a digest."""
    found: list[tuple[int, dict[str, str] | None, bytes | int]] = []
    inside, gap = 0, None
    while inside < len(content):
        parsed = parse_record(content, inside)
        if parsed is not None and (not checked or parsed[0].get("warc-block-digest")):
            if gap is not None:
                found.append((at, None, inside - gap))
                gap = None
            found.append((at, parsed[0], parsed[1]))
            inside = parsed[2]
            continue
        gap = inside if gap is None else gap
        version = _VERSION_LINE.search(content, inside + 1)
        inside = version.start() if version else len(content)
    if gap is not None:
        found.append((at, None, len(content) - gap))
    return found


def _at(data: bytes, at: int) -> tuple[list[tuple[int, dict[str, str] | None, bytes | int]], int | None] | None:
    """Records that start at ``at`` (none in an empty member) and where they end; None if a check fails there. A broken
    member has no end."""
    if data.startswith(_GZIP, at):
        member = _member_at(data, at)
        content, end = member or (_broken_member_at(data, at), None)
        found = _inside(content, at, end is None)
        if end is None:  # the member as a whole is the gap
            found = [f for f in found if f[1] is not None]
        return (found, end) if any(f[1] is not None for f in found) or end is not None and not content else None
    parsed = parse_record(data, at)
    return None if parsed is None else ([(at, parsed[0], parsed[1])], parsed[2])


def salvage(data: bytes) -> Iterator[tuple[int, dict[str, str] | None, bytes | int]]:
    """(offset, headers, block) per record, and (offset, None, length) per quarantined gap, in order."""
    at, gap = 0, None
    while at < len(data):
        found = _at(data, at)
        if found is not None:
            if gap is not None:
                yield gap, None, at - gap
                gap = None
            yield from found[0]
            if found[1] is not None:
                at = found[1]
                continue
        gap = at if gap is None else gap
        version = _VERSION_LINE.search(data, at + 1)
        starts = [data.find(_GZIP, at + 1), version.start() if version else -1]
        at = min((s for s in starts if s >= 0), default=len(data))
    if gap is not None:
        yield gap, None, len(data) - gap


def _number(name: str | None) -> int | None:
    digits = (name or "")[len("<urn:page:") : -1]
    return int(digits) if digits.lstrip("-").isdigit() else None


_READ = (
    "kind string, file string, position long, gap_bytes long, page_id long, uri string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record (kind ``record``) or quarantined gap (kind ``gap``) of the archives below ``path``.

    A response's payload is held against its own digest and length; a revisit states those of the payload it refers to.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("kind", pa.string()), ("file", pa.string()), ("position", pa.int64()), ("gap_bytes", pa.int64()),
            ("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows: list[tuple] = []
                for position, headers, block in salvage(content.as_py() or b""):
                    rows.append((name.as_py(), position, headers, block))
                    if len(rows) == 512:
                        yield _batch(rows, schema)
                        rows = []
                yield _batch(rows, schema)

    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        out = []
        for name, position, headers, block in rows:
            if headers is None:
                out.append(("gap", name, position, block, None, None, None, None, None, None, None))
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            stated = re.search(rb"(?i)content-length: *(\d+)", http)
            kind, digest = headers.get("warc-type"), headers.get("warc-payload-digest", "").removeprefix("sha1:")
            size = int(stated.group(1)) if stated else len(payload)
            if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                kind = "damaged"
            out.append((
                "record", name, position, None, _number(headers.get("warc-record-id")), headers.get("warc-target-uri"), kind,
                _number(headers.get("warc-refers-to")), size, digest, payload if with_payload and kind == "response" else None,
            ))
        columns = list(zip(*out)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parse, _READ)


def intact(rows: DataFrame) -> DataFrame:
    """What ``read_archives`` read, or an error where it holds a gap or a payload that differs from its digest."""
    whole = (F.col("kind") == "record") & F.col("record_type").isin("response", "revisit")
    at = F.concat(F.lit("damaged archive: "), F.col("file"), F.lit(" at "), F.col("position").cast("string"))
    return rows.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(at).cast("boolean")))


def archived(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read every record back; damage is an error."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return intact(read_archives(spark, path, with_payload=False))
