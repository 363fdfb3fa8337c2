"""WARC archives: a writer with one gzip member per record, and a salvage reader.

Spark's text writer puts the members into files (any store that Spark can write, committed task
by task): a member's last byte is the top byte of its size, 0, which serves as the line end.  Lines are
bundles of some megabytes, and a file holds a fixed number of them, so that a file fits a task.  The
reader checks every member and record; where a check fails it searches for the next member or
version line that holds a valid record, goes on there, and logs the bytes between as a gap.  Inside a
member it does so over the decompressed bytes, as far as they come out of a torn or damaged one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLE_BYTES = 4 << 20  # members that are written as one line
BUNDLES_PER_FILE = 16   # so a file holds at most 16 times the larger of twice this and one member
READ_SCHEMA = ("kind string, file string, offset long, length long, reason string, record_id string, record_type string, "
               "uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, inner_offset long")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(kind: str, record_id: str, uri: str | None, payload: bytes | None, digest: str, size: int, refers_to: str | None) -> bytes:
    block = b""
    if kind == "response":
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", uri and quote(uri, safe="%/:=&?~#+!$,;'@()*[]")),
              ("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
              ("WARC-Refers-To", refers_to and f"<{refers_to}>"), ("WARC-Profile", PROFILE if kind == "revisit" else None),
              ("Payload-Length", str(size)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = c.compress(data) + c.flush()
    if out[-1]:  # a record of 16 MB or more: an empty member after it ends in 0
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += c.compress(b"") + c.flush()
    return out


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   bundle_bytes: int = BUNDLE_BYTES, bundles_per_file: int = BUNDLES_PER_FILE) -> None:
    """Writes a record per row of ``pages`` to files under ``path``.

    Members are written in bundles, and files are bounded by bundles: so by bytes, however long the payloads.
    Of rows with equal payloads (null: empty) that with the largest key is the response and the others
    revisit it; rows that share that key are each a response, as are rows of which no key is known.
    Only the three named columns are read; an empty table writes no records."""
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    largest = rows.groupBy(F.col("sha").alias("s")).agg(F.max("id").alias("response"))
    rows = rows.join(largest, F.col("sha") == F.col("s")).select("id", "url", "html", "response")

    def members(batches):
        for b in batches:
            for k in range(b.num_rows):
                i, url, html, first = (b.column(c)[k].as_py() for c in range(4))
                data = html.encode()
                kind = "response" if i == first else "revisit"
                yield gzip_member(record_bytes(kind, f"urn:page:{'' if i is None else i}", url, data, sha1_base32(data), len(data),
                                               None if kind == "response" else f"urn:page:{first}"))

    def run(batches):
        for bundle in bundles(members(batches), bundle_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([bundle[:-1]], pa.binary())], names=["bundle"])

    rows.mapInArrow(run, "bundle binary").select(F.col("bundle").cast("string").alias("value")) \
        .write.option("lineSep", "\0").option("maxRecordsPerFile", bundles_per_file).text(path)


def bundles(members: Iterable[bytes], limit: int = BUNDLE_BYTES) -> Iterator[bytes]:
    """Neighbouring members as one, of at least ``limit`` bytes but for the last; a member as long is one by itself."""
    held, size = [], 0
    for m in members:
        if held and len(m) >= limit:
            yield b"".join(held)
            held, size = [], 0
        held.append(m)
        size += len(m)
        if size >= limit:
            yield b"".join(held)
            held, size = [], 0
    if held:
        yield b"".join(held)


# ---------------------------------------------------------------- reading

class Reason(str):
    """Why bytes are a gap; inner_offset: where in the decompressed bytes of the member, if in one."""

    inner_offset: int | None = None

    @classmethod
    def inside(cls, reason: str, at: int) -> "Reason":
        out = cls(reason)
        out.inner_offset = at
        return out


def _member(data: memoryview, at: int) -> tuple[bytes, int | None]:
    """The content of the gzip member at ``at`` and its end; None as the end, after what comes out, if it is not whole."""
    d, out, q, step = zlib.decompressobj(31), [], at, 65536
    while not d.eof:
        if q >= len(data):
            return b"".join(out), None
        before = d.copy()
        try:
            out.append(d.decompress(data[q:q + step]))
            q += step
        except zlib.error:  # what comes out before the bad byte counts: again in smaller steps
            if step == 1:
                return b"".join(out), None
            d, step = before, step // 2
    return b"".join(out), min(q, len(data)) - len(d.unused_data)


_HEAD = re.compile(rb"WARC/1\.[01]\r\n((?:[!-9;-~]+:[^\r\n]*\r\n)+)\r\n")


def _record(data, at: int) -> tuple[dict, int] | str:
    """The record at ``at`` of plain bytes and its end, or what is wrong with it."""
    m = _HEAD.match(data, at)
    if not m:
        return "no record header"
    head = {}
    for line in m[1].split(b"\r\n")[:-1]:
        k, _, v = line.partition(b":")
        head[k.decode().lower()] = v.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        return "no content length"
    end = m.end() + int(head["content-length"])
    if bytes(data[end:end + 4]) != b"\r\n\r\n":
        return "record cut short or of another length"
    block = bytes(data[m.end():end])
    if (want := head.get("warc-block-digest", "")).startswith("sha1:") and want[5:] != sha1_base32(block):
        return "block digest differs"
    digest, payload = head.get("warc-payload-digest", "").removeprefix("sha1:"), None
    if head.get("warc-type") == "response":
        payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
        if digest and digest != sha1_base32(payload):
            return "payload digest differs"
    strip = lambda k: head.get(k, "").strip("<>") or None
    size = len(payload) if payload is not None else int(n) if (n := head.get("payload-length", "")).isdigit() else None
    return {"record_id": strip("warc-record-id"), "record_type": head.get("warc-type"), "uri": strip("warc-target-uri"),
            "refers_to": strip("warc-refers-to"), "payload_digest": digest or None, "payload_bytes": size, "payload": payload,
            "verified": want.startswith("sha1:")}, end + 4


_VERSION = re.compile(re.escape(VERSION))


def _inside(text: bytes) -> list[tuple]:
    """``("record", inner offset, fields)`` and ``("gap", inner offset, length, reason)`` of a member's content."""
    out, k = [], 0
    while k < len(text):
        r = _record(text, k)
        if not isinstance(r, str):
            out.append(("record", k, r[0]))
            k = r[1]
            continue
        to = next((m.start() for m in _VERSION.finditer(text, k + 1) if not isinstance(_record(text, m.start()), str)), len(text))
        out.append(("gap", k, to - k, r))
        k = to
    return out


def _valid(data: memoryview, at: int):
    """``found, end`` of the member (as ``_inside``; end None: not whole) or plain record at ``at``, or what is wrong
    if it holds no record."""
    if data[at:at + 3] == MAGIC:
        text, end = _member(data, at)
        found = _inside(text)
        if end is None and found and found[-1][0] == "record" and not found[-1][2]["verified"]:
            found[-1] = ("gap", found[-1][1], 0, "gzip member broken")  # no digest tells whether its bytes are right
        if not any(x[0] == "record" for x in found) and (found or end is None):
            return "gzip member broken" if end is None else found[0][3]
        if end is None:
            k = found.pop()[1] if found[-1][0] == "gap" else len(text)
            found.append(("gap", k, len(text) - k, "gzip member broken"))
        return found, end
    if data[at:at + len(VERSION)] == VERSION:
        r = _record(data, at)
        return r if isinstance(r, str) else ([("record", None, r[0])], r[1])
    return "neither a member nor a version line"


_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def salvage(data: bytes):
    """``("record", offset, length, fields)`` and ``("gap", offset, length, reason)`` in the order of the bytes.

    Offset and length are those of the plain record, the whole member or the gap; a broken member goes up to the
    next place that holds a valid record.  A gap inside a member that holds records has the member's offset, its
    own length in decompressed bytes, and a reason with ``inner_offset``; fields have that too."""
    view, at = memoryview(data), 0

    def after(to):  # the next valid place and what it holds, so that it is not read twice
        while m := _NEXT.search(data, to + 1):
            to = m.start()
            if not isinstance(got := _valid(view, to), str):
                return to, got
        return len(data), None

    got = _valid(view, at) if data else None
    while at < len(data):
        if isinstance(got, str):
            to, following = after(at)
            yield "gap", at, to - at, Reason(got)
        else:
            found, to = got
            to, following = after(at) if to is None else (to, _valid(view, to) if to < len(data) else None)
            for x in found:
                if x[0] == "record":
                    yield "record", at, to - at, x[2] | {"inner_offset": x[1]}
                else:
                    yield "gap", at, x[2], Reason.inside(x[3], x[1])
        at, got = to, following


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of ``READ_SCHEMA``: records of all files under ``path``, and gaps (kind ``gap``, with offset,
    length and reason) for bytes that hold none.  Files are read whole, one at a time in a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                file, data, rows = b.column(0)[i].as_py(), b.column(1)[i].as_py(), []
                held = 0
                for kind, at, n, what in salvage(data):
                    row = dict.fromkeys(names) | {"kind": kind, "file": file, "offset": at, "length": n}
                    row |= {"reason": str(what), "inner_offset": what.inner_offset} if kind == "gap" else what
                    if not with_payload:
                        row["payload"] = None
                    held += len(row["payload"] or b"")
                    rows.append(row)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield _batch(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.mapInArrow(run, READ_SCHEMA)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    types = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary(), "inner_offset": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types.get(k, pa.string())) for k in names], names=names)
