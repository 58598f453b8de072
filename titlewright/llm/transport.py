"""Payloads in MPEG transport streams: packing them, and taking streams apart again.

A stream has one program: an association table, a map table and one elementary stream of private data. A unit is a frame
of 192 bytes that stands for 24 ms; twelve make up a packet of the elementary stream, with its presentation time. Every
fourth such packet is a random-access point: tables come before it, and it carries a clock reference.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlewright.llm.arrow import longs, map_arrow

PACKET, FRAME, TICKS, FRAMES, ACCESS = 188, 192, 2160, 12, 4
PMT_PID, DATA_PID = 0x1000, 0x0100
_WRAP = 1 << 33


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c >> 31 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\0\0" + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def _table_packets(pid: int, section: bytes) -> list[bytes]:
    """The table's packet for each value of the continuity counter."""
    body = (b"\0" + section).ljust(PACKET - 4, b"\xff")
    return [b"\x47" + (0x4000 | pid).to_bytes(2, "big") + bytes([0x10 | cc]) + body for cc in range(16)]


_PAT = _table_packets(0, _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")))
_PMT = _table_packets(PMT_PID, _section(2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\0" + b"\x06" + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\0"))
_DATA = [b"\x47" + DATA_PID.to_bytes(2, "big") + bytes([0x10 | cc]) for cc in range(16)]


def _stamp(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, pts >> 14 & 0xFE | 1, pts >> 7 & 0xFF, pts << 1 & 0xFE | 1])


def mux(payload: bytes) -> bytes:
    """The transport stream of a payload of whole frames."""
    if not payload or len(payload) % FRAME:
        raise ValueError(f"a payload has a positive multiple of {FRAME} bytes")
    out: list[bytes] = []
    cc = tables = 0
    for k, at in enumerate(range(0, len(payload), FRAME * FRAMES)):
        data = payload[at : at + FRAME * FRAMES]
        pts = at // FRAME * TICKS % _WRAP
        body = b"\0\0\1\xbd" + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(pts) + data
        field_ = b""
        if k % ACCESS == 0:
            out += (_PAT[tables & 15], _PMT[tables & 15])
            tables += 1
            field_ = b"\x50" + (pts << 15 | 0x7E00).to_bytes(6, "big")
        at_body, start = 0, 0x40
        while at_body < len(body):
            room = PACKET - 4 - (len(field_) + 1 if field_ else 0)
            left = len(body) - at_body
            if left < room:  # stuffing goes into the adaptation field
                need = room - left
                if not field_:
                    field_, need = (b"\0", need - 2) if need > 1 else (b"", need - 1)
                    extra = bytes([len(field_) + need]) + field_ + b"\xff" * need
                else:
                    extra = bytes([len(field_) + need]) + field_ + b"\xff" * need
            else:
                extra = bytes([len(field_)]) + field_ if field_ else b""
            size = PACKET - 4 - len(extra)
            if extra or start:
                out.append(b"\x47" + (start << 8 | DATA_PID).to_bytes(2, "big") + bytes([(0x30 if extra else 0x10) | cc]) + extra)
            else:
                out.append(_DATA[cc])
            out.append(body[at_body : at_body + size])
            at_body += size
            cc = cc + 1 & 15
            start, field_ = 0, b""
    return b"".join(out)


@dataclass
class Stream:
    """One elementary stream: its kind, its packets' data, times (unwrapped) and random-access points (time, offset)."""

    pid: int
    kind: int
    program: int
    data: list[bytes] = field(default_factory=list)
    times: list[int | None] = field(default_factory=list)
    points: list[tuple[int | None, int]] = field(default_factory=list)
    lost: int = 0
    broken: int = 0


def _tables(section: bytes) -> bytes | None:
    """A whole section whose check sum holds."""
    if len(section) < 4:
        return None
    n = 3 + (section[1] << 8 & 0xF00 | section[2])
    return section[:n] if len(section) >= n > 11 and crc32_mpeg(section[:n]) == 0 else None


class _Open:
    __slots__ = ("parts", "size", "rap", "offset", "good")

    def __init__(self, part: bytes, rap: bool, offset: int):
        self.parts, self.size, self.rap, self.offset, self.good = [part], len(part), rap, offset, True


def _close(s: Stream, unit: _Open | None) -> None:
    if unit is None:
        return
    pes = b"".join(unit.parts)
    if not unit.good or len(pes) < 9 or pes[:3] != b"\0\0\1" or pes[6] & 0xC0 != 0x80:
        s.broken += 1
        return
    length = pes[4] << 8 | pes[5]
    end = 6 + length if length else len(pes)
    if end > len(pes):
        s.broken += 1
        return
    pts = None
    if pes[7] & 0x80 and pes[8] >= 5:
        p = pes[9:14]
        pts = (p[0] >> 1 & 7) << 30 | p[1] << 22 | p[2] >> 1 << 15 | p[3] << 7 | p[4] >> 1
        last = next((t for t in reversed(s.times) if t is not None), None)
        if last is not None:  # the nearest time to the last one, counters having 33 bits
            pts += (last - pts + _WRAP // 2) // _WRAP * _WRAP
    s.data.append(pes[9 + pes[8] : end])
    s.times.append(pts)
    if unit.rap:
        s.points.append((pts, unit.offset))


def demux(ts: bytes) -> dict[int, Stream]:
    """The elementary streams of a transport stream, by PID.

    Packets that repeat their predecessor are dropped, gaps in a counter break the packet that they fall into and are
    counted as lost, as are packets that say they have errors. After a lost sync byte the next place with two is taken.
    """
    streams: dict[int, Stream] = {}
    open_: dict[int, _Open] = {}
    sections: dict[int, bytearray] = {}
    programs: dict[int, int] = {}  # PID of a map table: program
    counters: dict[int, int] = {}
    at, n = 0, len(ts)
    while at + PACKET <= n:
        if ts[at] != 0x47:
            at += 1
            while at < n and (ts[at] != 0x47 or at + PACKET < n and ts[at + PACKET] != 0x47):
                at += 1
            continue
        b1, b3 = ts[at + 1], ts[at + 3]
        pid = b1 << 8 & 0x1F00 | ts[at + 2]
        begin, here = at + 4, at
        at += PACKET
        flags = 0
        if b3 & 0x20:
            size = ts[begin]
            flags = ts[begin + 1] if size else 0
            begin += 1 + size
        if not b3 & 0x10 or pid == 0x1FFF or b1 & 0x80 or begin > at:
            continue
        cc = b3 & 15
        had = counters.get(pid)
        counters[pid] = cc
        s = streams.get(pid)
        if had is not None and not flags & 0x80 and cc != (had + 1 & 15):
            if cc == had:
                continue
            if s is not None:
                s.lost += 1
            if pid in open_:
                open_[pid].good = False
            sections.pop(pid, None)
        if s is not None:
            if b1 & 0x40:
                _close(s, open_.get(pid))
                open_[pid] = _Open(ts[begin:at], bool(flags & 0x40), here)
            elif pid in open_:
                open_[pid].parts.append(ts[begin:at])
        elif pid == 0 or pid in programs:
            if b1 & 0x40:
                sections[pid] = bytearray(ts[begin + 1 + ts[begin] : at])
            elif pid in sections:
                sections[pid] += ts[begin:at]
            table = _tables(bytes(sections.get(pid, b"")))
            if table is None:
                continue
            del sections[pid]
            if pid == 0 and table[0] == 0:
                for i in range(8, len(table) - 4, 4):
                    if number := table[i] << 8 | table[i + 1]:
                        programs[table[i + 2] << 8 & 0x1F00 | table[i + 3]] = number
            elif table[0] == 2:
                i = 12 + (table[10] << 8 & 0xF00 | table[11])
                while i + 5 <= len(table) - 4:
                    own = table[i + 1] << 8 & 0x1F00 | table[i + 2]
                    streams.setdefault(own, Stream(own, table[i], programs[pid]))
                    i += 5 + (table[i + 3] << 8 & 0xF00 | table[i + 4])
    for pid, unit in open_.items():
        _close(streams[pid], unit)
    return streams


def padded(text: bytes | None) -> bytes:
    text = text or b""
    return text + b" " * (-len(text) % FRAME if text else FRAME)


def _store_rows(it):
    for batch in it:
        texts = batch.column("text")
        for lo in range(0, len(texts), 128):
            part = texts.slice(lo, 128).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, 128), longs(np.array([len(t or b"") for t in part])), pa.array([mux(padded(t)) for t in part], pa.binary())], ["doc_id", "n_bytes", "media"])


def store_transport(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each text's bytes, filled up with spaces to whole frames, as a transport stream.

    Null and empty texts are one frame of spaces. Equal texts give equal streams, repeated rows and null ids pass through,
    other columns are ignored, and an empty table gives no rows. A text is held in memory as a whole, with its stream.
    """
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_arrow(src, _store_rows, "doc_id bigint, n_bytes bigint, media binary")


_POINTS = "points array<struct<pts:bigint,offset:bigint>>"


def _read_rows(it, digest: bool):
    for batch in it:
        media = batch.column("media")
        rest = [c for c in batch.schema.names if c != "media"]
        for lo in range(0, len(media), 128):
            rows = []
            for x in media.slice(lo, 128):
                ts = x.as_buffer().to_pybytes() if x.is_valid else b""
                streams = demux(ts)
                s = streams[min(streams)] if streams else Stream(0, 0, 0)
                payload = b"".join(s.data)
                times = [t for t in s.times if t is not None]
                feature = f"streams={len(streams)};kind={s.kind};packets={len(ts) // PACKET};units={len(s.data)};points={len(s.points)};first={times[0] if times else -1};last={times[-1] if times else -1};lost={s.lost};broken={s.broken}"
                kept = (hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(ts), hashlib.sha256(ts).hexdigest()) if digest else (payload, s.times)
                rows.append((len(payload), *kept, feature, [{"pts": p, "offset": o} for p, o in s.points]))
            kinds = [pa.int64(), *((pa.string(), pa.int64(), pa.int64(), pa.string()) if digest else (pa.binary(), pa.list_(pa.int64()))), pa.string(), pa.list_(pa.struct([("pts", pa.int64()), ("offset", pa.int64())]))]
            names = ["payload_bytes", *(("payload_sha256", "tail_crc32", "media_bytes", "media_sha256") if digest else ("payload", "times")), "feature", "points"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, 128) for c in rest), *columns], [*rest, *names])


def read_transport(media: DataFrame, digest: bool = False) -> DataFrame:
    """Each stream taken apart: the payload and times of its first elementary stream, a summary and the random-access points
    with their times and offsets; other columns are kept, but for those of the result's own names, which are replaced. With
    digest, hashes stand for payload and media. A null or foreign stream has an empty payload and no points. Repeated rows are
    read alike, an empty table gives no rows, and a stream, however long, is held in memory as a whole."""
    made = {"payload_bytes", "feature", "points", *(("payload_sha256", "tail_crc32", "media_bytes", "media_sha256") if digest else ("payload", "times"))}
    media = media.select(*[F.col(f"`{c}`").alias(c) for c in media.columns if c not in made])
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in media.schema if f.name != "media")
    own = "payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string" if digest else "payload binary, times array<bigint>"
    return map_arrow(media, lambda it: _read_rows(it, digest), f"{kept}, payload_bytes bigint, {own}, feature string, {_POINTS}")
