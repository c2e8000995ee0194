"""WARC archives: a writer with revisit records and a salvage reader.

Archives are gzip files with one member per record.  They are written by
Spark's own text writer (any Hadoop file system, usual commit protocol): a
row is one record's gzip member as raw bytes, and the line separator is an
empty gzip member, so the concatenation is a valid multi-member file.

The reader checks every member (gzip CRC) and every record (version line,
Content-Length, SHA-1 payload digest).  After a failed check it searches for
the next gzip magic or version line that begins a valid record, goes on from
there, and logs the skipped bytes as a quarantined gap.  Plain (uncompressed)
archives and mixtures are read by the same rules.

A member may hold many records.  Inside its text the search for the next
version line is the same, and an inner gap is logged with the range of the
member and its place in the text as reason.  Of a member that breaks off or
fails its CRC, the records that the decompressor gave are kept if a digest of
their own proves them; the last one before a break is taken only if more text
follows it.  The gap of such a member begins at the member.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import map_arrow

GZIP_MAGIC = b"\x1f\x8b\x08"
#: A gzip member of no bytes; as text in ISO-8859-1 it is the line separator.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + b"\x00" * 8
# Names of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORD_SCHEMA = ("archive string, start long, end long, record_id string, record_type string, target_uri string, "
                 "payload_bytes long, payload_digest string, refers_to string, payload binary")
GAP_SCHEMA = "archive string, start long, end long, reason string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value) -> str:
    """A header value without control characters (CR and LF would forge headers)."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def record_bytes(record_id: str, uri: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One uncompressed WARC record: a response, or with ``refers_to`` a
    revisit whose block has the HTTP header only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Target-URI: {_line(uri)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ---- salvage parsing ---------------------------------------------------------

class BadRecord(ValueError):
    pass


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord("header line without a colon")
        out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(data: bytes, pos: int, proof: bool = False) -> tuple[dict, int]:
    """The record at ``pos`` and the position after it; BadRecord if any check
    fails, with ``proof`` also if no digest covers the payload."""
    if not _VERSION.match(data, pos):
        raise BadRecord("no version line")
    end = data.find(b"\r\n\r\n", pos)
    if end < 0:
        raise BadRecord("header without an end")
    head = _headers(data[pos:end])
    if not all(head.get(name) for name in ("warc-record-id", "warc-type", "warc-date")):
        raise BadRecord("a mandatory header is missing")
    length = head.get("content-length", "")
    if not length.isdigit():
        raise BadRecord("no content length")
    start = end + 4
    stop = start + int(length)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise BadRecord("content length does not end at a record end")
    block = data[start:stop]
    said = head.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != sha1_base32(block):
        raise BadRecord("block digest differs")
    kind, is_http = head.get("warc-type", ""), head.get("content-type", "").startswith("application/http")
    http, sep, payload = block.partition(b"\r\n\r\n") if is_http else (b"", b"", block)
    if is_http and not sep:
        raise BadRecord("HTTP header without an end")
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        declared = _headers(http).get("content-length", "")
        size, payload = (int(declared) if declared.isdigit() else None), None
    else:
        size = len(payload)
        actual = sha1_base32(payload)
        if digest and digest != actual:
            raise BadRecord("payload digest differs")
        digest = actual
    strip = lambda v: v.strip("<>") if v is not None else None
    if proof and not said.startswith("sha1:") and (kind == "revisit" or not head.get("warc-payload-digest", "").startswith("sha1:")):
        raise BadRecord("no digest proves a record of a damaged member")
    return {"record_id": strip(head.get("warc-record-id")), "record_type": kind, "target_uri": head.get("warc-target-uri"),
            "payload_bytes": size, "payload_digest": digest, "refers_to": strip(head.get("warc-refers-to")),
            "payload": payload}, stop + 4


#: Bytes that the decompressor is given at once: what it has not read of them
#: at a member's end is copied, so the rest of the archive must not be among it.
PIECE = 1 << 14


def _member(data: bytes, pos: int) -> tuple[bytes, int]:
    z, view, out, at = zlib.decompressobj(31), memoryview(data), [], pos
    try:
        while at < len(data) and not z.eof:
            out.append(z.decompress(view[at:at + PIECE]))
            at = min(at + PIECE, len(data))
    except zlib.error as e:
        raise BadRecord(f"gzip: {e}") from None
    if not z.eof:
        raise BadRecord("gzip member without an end")
    return b"".join(out), at - len(z.unused_data)


def _broken(data: bytes, pos: int) -> tuple[bytes, bool, list[tuple[int, int]]]:
    """What the decompressor gives of the damaged member at ``pos``, whether
    its text is complete (only the check value failed), and marks (bytes
    read, bytes given)."""
    z, view, out, marks = zlib.decompressobj(31), memoryview(data), bytearray(), []
    step, at = 256, pos
    while at < len(data) and not z.eof:
        before = z.copy()
        try:
            out += z.decompress(view[at:at + step])
        except zlib.error as e:
            if step == 1:
                return bytes(out), "incorrect data check" in str(e) or "incorrect length check" in str(e), marks
            z, step = before, 1  # the output of the failing call is lost: byte by byte
            continue
        at += step
        marks.append((min(at, len(data)), len(out)))
    return bytes(out), False, marks


def _inside(text: bytes, damaged: bool = False, complete: bool = True) -> Iterator[tuple[str, int, int, object]]:
    """Records and gaps of a member's text, with places in the text."""
    pos, gap, reason = 0, None, ""
    while pos < len(text):
        try:
            one, after = parse_record(text, pos, damaged)
            if after == len(text) and not complete:
                raise BadRecord("the member breaks off at the record's end")
        except BadRecord as e:
            if gap is None:
                gap, reason = pos, str(e)
            m = _VERSION.search(text, pos + 1)
            pos = m.start() if m else len(text)
            continue
        if gap is not None:
            yield "gap", gap, pos, reason
            gap = None
        yield "record", pos, after, one
        pos = after
    if gap is not None:
        yield "gap", gap, len(text), reason


def _unit(data: bytes, pos: int) -> tuple[list[tuple[str, object]], int]:
    """Records and inner gaps of the gzip member, or the one plain record, at
    ``pos``.  A member with text but no valid record is a BadRecord."""
    if not data.startswith(GZIP_MAGIC, pos):
        one, after = parse_record(data, pos)
        return [("record", one)], after
    text, after = _member(data, pos)
    found = list(_inside(text))
    if text and not any(kind == "record" for kind, *_ in found):
        raise BadRecord(found[0][3])
    return [(kind, x if kind == "record" else f"bytes {a} to {b} of the member: {x}") for kind, a, b, x in found], after


def _rescued(data: bytes, pos: int) -> tuple[list[dict], int]:
    """Proven records of the damaged member at ``pos`` and the position up to
    which their bytes go."""
    if not data.startswith(GZIP_MAGIC, pos):
        return [], pos
    text, complete, marks = _broken(data, pos)
    found = [(b, x) for kind, _, b, x in _inside(text, True, complete) if kind == "record"]
    if not found:
        return [], pos
    return [x for _, x in found], next(at for at, given in marks if given >= found[-1][0])


_VERSION = re.compile(rb"WARC/1\.\d\r\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.\d\r\n")


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """``("record", start, end, fields)`` and ``("gap", start, end, reason)``
    in file order; together they cover every byte except empty members.
    Records and inner gaps of one member share its range; records of a
    damaged member lie in its gap."""
    pos, gap, reason, done = 0, None, "", 0  # done: end of the bytes of rescued records
    while pos < len(data):
        try:
            found, after = _unit(data, pos)
        except BadRecord as e:
            rescued, upto = _rescued(data, pos) if pos >= done else ([], pos)
            if rescued and gap is not None and gap < pos:
                yield "gap", gap, pos, reason
                gap = None
            if gap is None:
                gap, reason = pos, str(e)
            for one in rescued:
                yield "record", pos, upto, one
            done = max(done, upto)
            m = _NEXT.search(data, pos + 1)
            while m and m.start() < done and not data.startswith(GZIP_MAGIC, m.start()):
                m = _NEXT.search(data, m.start() + 1)  # stored text of a rescued record
            pos = m.start() if m else len(data)
            continue
        if gap is not None:
            yield "gap", gap, pos, reason
            gap = None
        for kind, x in found:
            yield kind, pos, after, x
        pos = after
    if gap is not None:
        yield "gap", gap, len(data), reason


# ---- Spark operators ---------------------------------------------------------

def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """``id_col, payload, _first``: payload bytes (null: empty) and, for pages
    whose payload of ``min_bytes`` or more also has a smaller id, that id.

    Grouping is on SHA-256 and length; the group table (one partial aggregate
    per payload) has only rows that occur twice, so the join moves page bytes
    only if Spark finds that table too large to broadcast.  Rows that repeat
    the smallest id are responses too; a null id counts as larger than any.
    """
    p = pages.select(F.col(id_col).alias("_id"), *[F.col(c) for c in pages.columns if c not in (id_col, payload_col)],
                     F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b"")).alias("_payload"))
    key = F.struct(F.length("_payload").alias("n"), F.sha2("_payload", 256).alias("h"))
    keyed = p.filter(F.length("_payload") >= min_bytes).select("_id", key.alias("_key"))
    groups = (keyed.groupBy("_key").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1 and _first is not null").select("_key", "_first"))
    return (p.withColumn("_key", F.when(F.length("_payload") >= min_bytes, key)).join(groups, "_key", "left")
            .withColumn("_first", F.when(~F.col("_first").eqNullSafe(F.col("_id")), F.col("_first"))).drop("_key"))


def _write_batches(batches: Iterator[pa.RecordBatch], date: str, level: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, uris, firsts, payloads = (b.column(c).to_pylist() for c in ("_id", "_uri", "_first", "_payload"))
        out = []
        for i, uri, first, payload in zip(ids, uris, firsts, payloads, strict=True):
            name = "null" if i is None else i
            rec = record_bytes(f"urn:page:{name}", uri if uri else f"urn:page:{name}", payload,
                               None if first is None else f"urn:page:{first}", date)
            out.append(gzip_member(rec, level))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, records_per_archive: int = 2000, date: str = "1970-01-01T00:00:00Z",
                   level: int = 6) -> None:
    """Write one WARC record per row of ``pages`` below ``path``.

    The payload is the UTF-8 text (null: empty).  Of equal payloads of at
    least ``min_bytes`` bytes the smallest id is a response, the others are
    revisits that refer to it.  No archive has more than
    ``records_per_archive`` records.  An empty table gives no archives.
    """
    marked = mark_revisits(pages.select(F.col(id_col).alias("_pid"), F.col(uri_col).cast("string").alias("_uri"),
                                        F.col(payload_col).alias("_body")), "_pid", "_body", min_bytes)
    members = map_arrow(marked.select("_id", "_uri", "_first", "_payload"),
                        lambda it: _write_batches(it, date, level), "value binary")
    (members.select(F.col("value").cast("string")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", records_per_archive).text(path))


def _read_batches(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = ["kind", "archive", "start", "end", "record_id", "record_type", "target_uri", "payload_bytes",
             "payload_digest", "refers_to", "payload", "reason"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(),
             pa.string(), pa.string(), pa.binary(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
            rows = []
            for kind, start, end, x in salvage(content or b""):
                row = dict.fromkeys(names) | {"kind": kind, "archive": path, "start": start, "end": end}
                if kind == "gap":
                    row["reason"] = x
                else:
                    row |= x if with_payload else x | {"payload": None}
                rows.append(row)
                if len(rows) >= 500:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record and every quarantined gap of the archives below ``path``.

    ``kind`` is 'record' or 'gap'; a gap has ``archive, start, end, reason``.
    Whole archives are parsed in one task each, so keep them below the
    memory of a task (see ``records_per_archive``).  No archive: no rows.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).filter(~F.element_at(F.split("path", "/"), -1).rlike(r"^[._]")).select("path", "content"))
    return map_arrow(files, lambda it: _read_batches(it, with_payload),
                     "kind string, " + RECORD_SCHEMA + ", reason string")


def records(read: DataFrame) -> DataFrame:
    return read.filter("kind = 'record'").drop("kind", "reason")


def gaps(read: DataFrame) -> DataFrame:
    """The quarantine log: byte ranges that no valid record covers."""
    return read.filter("kind = 'gap'").select("archive", "start", "end", "reason")


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder, read them back, and
    return one row per record."""
    path = scratch_dir(spark, "warc")
    write_archives(pages, path, min_bytes=min_bytes)
    page = lambda c: F.when(F.col(c) != "urn:page:null", F.substring_index(c, ":", -1)).cast("long")
    return records(read_archives(spark, path, with_payload=False)).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))
