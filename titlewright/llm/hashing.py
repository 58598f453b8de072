"""Vectorised hashing of the words of whole texts, without a Python object per word.

Words are runs of bytes other than the six ASCII white-space bytes (0x20 and 0x09 to 0x0D). A word's hash is a
polynomial over a table of 64-bit values for each byte, modulo 2^64, with a final mix. Texts go through in segments of
about a megabyte, cut at white space, so memory doesn't grow with a text beyond its words' eight bytes each.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_CACHE: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spark_xxhash64(x: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64 gives for each bigint."""
    p1, p2, p3, p4, p5 = (U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, n: (v << U(n)) | (v >> U(64 - n))
    h = turn(x.view(U) * p2, 31) * p1 ^ (p5 + U(50))
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> U(33))) * p2
    h = (h ^ (h >> U(29))) * p3
    return (h ^ (h >> U(32))).view(np.int64)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64, for i below n."""
    have = _CACHE.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.ones(size, U)
            p[1:] = U(b)
            out.append(np.multiply.accumulate(p))
        have = _CACHE[base] = tuple(out)
    return have[0][:n], have[1][:n]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if "bytes" not in _CACHE:
        _CACHE["bytes"] = mix((np.arange(256, dtype=U) + U(1)) * U(0xD1B54A32D192ED03)) | U(1)
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        _CACHE["space"] = space
    return _CACHE["bytes"], _CACHE["space"]


def _segment(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table, space = _tables()
    gap = np.empty(len(buf) + 2, np.int8)
    gap[0] = gap[-1] = 1
    gap[1:-1] = space[buf]
    edge = np.diff(gap)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers(_BASE, len(buf) + 1)
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(table[buf] * power[: len(buf)], out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of data."""
    buf = np.frombuffer(data, np.uint8)
    if len(buf) <= SEGMENT * 2:
        return _segment(buf)
    space, parts, at = _tables()[1], [], 0
    while at < len(buf):
        to = min(at + SEGMENT, len(buf))
        while to < len(buf):  # up to the next white space
            found = np.flatnonzero(space[buf[to : to + 4096]])
            if len(found):
                to += int(found[0])
                break
            to = min(to + 4096, len(buf))
        s, e, h = _segment(buf[at:to])
        parts.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def grams(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes; empty if there are fewer words."""
    if len(h) < n:
        return np.empty(0, U)
    b = U(base | 1)
    acc = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        acc *= b
        acc += h[k : len(h) - n + 1 + k]
    return mix(acc)


def batches(texts: list, limit: int = SEGMENT):
    """Runs (from, to) of texts of at most about `limit` bytes together; a longer text is a run of its own."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > at and size + n > limit:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def joined(texts: list) -> tuple[bytes, np.ndarray]:
    """The texts in one buffer, with white space between them, and where each begins (one entry more than texts)."""
    sizes = np.fromiter((len(t) if t is not None else 0 for t in texts), np.int64, len(texts))
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes + 1, out=begins[1:])
    return b"\n".join(t or b"" for t in texts), begins


ASCII_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
