"""WARC archives of gzip members, written through Spark's committed output and read by byte ranges.

Writing: tasks compress each record to a gzip member of its own and hand Spark's text writer rows of some megabytes of
members. The writer ends each row with a separator, which is here an empty gzip member, so every file is a valid sequence
of members, and a lost task's output is never seen. Reading: files are cut into byte ranges. A task looks for gzip's magic
bytes in its range, takes a place for a member only if what it decodes to begins as a record, and reads every record that
starts inside its range, to the record's end.
"""

from __future__ import annotations

import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.llm.arrow import map_arrow
from titlewright.llm.files import open_fs
from titlewright.llm.skew import keyed_join
from titlewright.session import materialize

MAGIC = b"\x1f\x8b\x08"
#: Fixed value: a gzip member of no bytes.
EMPTY_MEMBER = b"\x1f\x8b\x08\0\0\0\0\0\0\x03\x03\0\0\0\0\0\0\0\0\0"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ROW = 2 << 20


#: So many repeated payloads, some 20 MB of digests, are broadcast.
_FEW = 200_000


def roles(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, digest, refers_to: refers_to is set for those whose payload a larger page_id also has.

    Payloads are equal if their SHA-256 and sizes are. Roles are found on ids, hashes and sizes. Payloads stay where they are if
    those that repeat are few; of more than that, those that very many pages have still do."""
    src = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    size, strong = F.length("payload"), F.when(F.length("payload") >= least_bytes, F.unhex(F.sha2("payload", 256)))
    large = src.select("page_id", strong.alias("strong"), size.alias("size")).where("strong is not null")
    most = large.groupBy("strong", "size").agg(F.max("page_id").alias("winner"), F.min(F.coalesce("page_id", F.lit(-(1 << 63)))).alias("least"), F.count("*").alias("n"))
    most = materialize(most.where("least < winner").drop("least"), "repeated")
    own = src.withColumn("digest", F.sha1("payload")).withColumn("strong", strong).withColumn("size", size)
    if most.limit(_FEW + 1).count() <= _FEW:
        out = own.join(F.broadcast(most.drop("n")), ["strong", "size"], "left")
    else:
        out = keyed_join(own, most, ["strong", "size"], "left")
    to = F.when(F.coalesce("page_id", F.lit(-(1 << 63))) < F.col("winner"), F.col("winner"))
    return out.select("page_id", "url", "payload", "digest", to.alias("refers_to"))


def _record(page, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page if page is not None else ''}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    block = http + (payload if refers_to is None else b"")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member_rows(it, date: str, level: int):
    held, size = [], 0
    for batch in it:
        for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
            squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
            held.append(squeeze.compress(_record(*row, date)) + squeeze.flush())
            size += len(held[-1])
            if size >= _ROW:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["members"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["members"])


def write_warc(pages: DataFrame, path: str, least_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> None:
    """A record for each row of pages (page_id, url, html; other columns are ignored) in archives below path.

    Of rows with equal payloads of at least `least_bytes` bytes, those of the largest page_id are responses and the others
    revisit it; smaller ones are all responses. Repeated rows of the largest page_id are all responses. A null html is an empty
    payload, a null url leaves its header out, a null page_id is less than any other and stays null when read. Record ids are made
    of page ids, so rows that repeat one have the same. Bytes of a url that a header can't hold are percent-encoded. A payload, however
    long, is one record, which a worker holds whole. An empty table gives archives without records.
    """
    members = map_arrow(roles(pages, least_bytes), lambda it: _member_rows(it, date, level), "members binary")
    members.select(F.col("members").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class _Window:
    """Bytes of a file by position, read ahead a megabyte at a time."""

    def __init__(self, file, ahead: int = 1 << 20):
        self.file, self.size, self.ahead, self.at, self.buf = file, file.size(), ahead, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.buf):
            self.file.seek(at)
            self.at, self.buf = at, self.file.read(max(n, self.ahead))
        return self.buf[at - self.at : at - self.at + n]

    def find(self, what: bytes, at: int, end: int) -> int:
        """The first place of `what` that starts in [at, end), else -1."""
        while at < end:
            part = self.get(at, min(1 << 16, end - at) + len(what) - 1)
            if (k := part.find(what)) >= 0 and at + k < end:
                return at + k
            at += 1 << 16
        return -1


def _member(w: _Window, at: int) -> tuple[bytes, int] | None:
    """The content of the member at a place and where it ends; None if no record's member is there."""
    out, pos = [], at
    un = zlib.decompressobj(31)
    try:
        first = un.decompress(w.get(at, 512), 64)
        if first[:5] != b"WARC/"[: len(first)] or not first:
            return None
        out.append(first)
        pos += 512
        feed = un.unconsumed_tail
        while not un.eof:
            if not feed:
                feed = w.get(pos, 1 << 15)
                pos += 1 << 15
                if not feed:
                    return None  # cut off
            out.append(un.decompress(feed))
            feed = b""
    except zlib.error:
        return None
    content = b"".join(out)
    return (content, min(pos, w.size) - len(un.unused_data)) if content.startswith(b"WARC/") else None


_HEADER = re.compile(rb"^([^:\r\n]+):[ \t]*([^\r\n]*)\r?$", re.M)


def _parse(content: bytes) -> tuple | None:
    head, gap, rest = content.partition(b"\r\n\r\n")
    if not gap:
        return None
    h = {k.lower(): v for k, v in _HEADER.findall(head)}
    block = rest[: int(h.get(b"content-length", b"0"))]
    kind = h.get(b"warc-type", b"").decode("latin-1")
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = {k.lower(): v for k, v in _HEADER.findall(http)}.get(b"content-length")
    page = lambda v: int(m[1]) if v and (m := re.fullmatch(rb"<urn:page:(-?\d+)>", v)) else None
    size = int(declared) if kind == "revisit" and declared else len(payload)
    return page(h.get(b"warc-record-id")), h.get(b"warc-target-uri", b"").decode("latin-1") or None, kind, page(h.get(b"warc-refers-to")), size, h.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:"), None if kind == "revisit" else payload


_FIELDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, declared_digest string, payload binary"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("declared_digest", pa.string()), ("payload", pa.binary())])


def _range_rows(it):
    for batch in it:
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
            system, name = open_fs(path)
            rows, held = [], 0
            with system.open_input_file(name) as f:
                w, at = _Window(f), start
                while (at := w.find(MAGIC, at, end)) >= 0:
                    got = _member(w, at)
                    if got is None:
                        at += 1
                        continue
                    content, at = got
                    if (row := _parse(content)) is not None:
                        rows.append(row)
                        held += len(content)
                        if held >= _ROW:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)
                            rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def read_warc(spark: SparkSession, path: str, range_bytes: int = 4 << 20) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, declared_digest and payload (null for a revisit) of all records
    of the archives below path. Damaged members are passed over; the next whole one is found by its magic bytes."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    total = files.agg(F.coalesce(F.sum(F.ceil(F.col("length") / range_bytes)), F.lit(0))).first()[0]
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("start")
    ranges = files.select("path", "length", start).select("path", "start", F.least("length", F.col("start") + range_bytes).alias("end"))
    return map_arrow(ranges.repartition(max(1, int(total)), "path", "start"), _range_rows, _FIELDS)
