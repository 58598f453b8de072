"""Exact removal of repeated word sequences with a log-structured index of window fingerprints.

A window is `window` consecutive words of one document. Its fingerprint is a pair: the least hash among the runs of
`anchor` words in it (mixed once more, so that it is even), which neighbouring windows share and which is therefore stored
once for all of them, and a 48-bit check value over all of its words. A fingerprint makes a window a candidate; its words are
compared with those of the earlier window before it counts as repeated, so no collision removes a word.

The index is a folder. A manifest, a new file for each change, lists its runs and its archives. A run is immutable: the
distinct fingerprints that a batch brought, with the document that has each first, in order. An archive holds a batch's
texts, in chunks by a hash of the document's id. A new batch is archived and fingerprinted chunk by chunk; its fingerprints
are dealt out in ranges, sorted, and merge-joined with the same range of each run, piece by piece. What no run holds becomes
a run of its own. Of the documents that have a candidate first, only the wanted passages are read out of the archives and sent
to the chunks that repeat them, where the words are compared. Before a batch is added, runs of a level are compacted as
soon as there are `fan_in` of them, in a streamed merge, so a batch meets a logarithmic number of runs.

Each chunk sends a fingerprint at most once, with its least document, so a passage of a third of all documents
brings a range no more than a row for each chunk.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.llm.arrow import groups, longs, map_arrow
from titlewright.llm.files import create_text, names, parts, read_text
from titlewright.llm.hashing import SEGMENT, U, batches, grams, joined, mix, spark_xxhash64, words
from titlewright.session import drop_path, release_shuffles, scratch, settings

_GRAM = 0xD6E8FEB86659FD93
_WINDOW = 0xA0761D6478BD642F
_PIECE = 1 << 16
_FOLDERS = 1024
_LEAST = -(1 << 63)
#: Blobs travel in small batches, so that what Spark holds for Arrow outside its heap stays small.
_SMALL = {"spark__sql__execution__arrow__maxBytesPerBatch": str(4 << 20)}
_MERGED = "kind string, folder int, bucket int, seq bigint, archive int, chunk bigint, data binary"
_MERGED_ARROW = pa.schema([("kind", pa.string()), ("folder", pa.int32()), ("bucket", pa.int32()), ("seq", pa.int64()), ("archive", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())])


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours, in a logarithmic number of passes."""
    have, m = 1, x
    while have * 2 <= n:
        m = np.minimum(m[: len(m) - have], m[have:])
        have *= 2
    return np.minimum(m[: len(m) - (n - have)], m[n - have :]) if have < n else m


def fingerprints(h: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and check value of the window at each word, for one document's (or buffer's) word hashes."""
    if len(h) < window:
        return np.empty(0, U), np.empty(0, U)
    return mix(_least(grams(h, anchor, _GRAM), window - anchor + 1)), grams(h, window, _WINDOW) & U((1 << 48) - 1)


def _key(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """What fingerprints are sorted by first: 40 bits of the anchor and 24 of the check value. Ties go by anchor and check value."""
    return (a & ~U((1 << 24) - 1)) | (c >> U(24))


def _order(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of fingerprints, of equal ones as they come, and where in it each distinct one begins."""
    key = _key(a, c)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    x, y, k = a[order], c[order], key[order]
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    if (new[1:] & (k[1:] == k[:-1])).any():  # different ones share a key
        order = np.lexsort((c, a, key))
        x, y = a[order], c[order]
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return order, new


def _lookup(have: tuple[np.ndarray, np.ndarray], a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Where among fingerprints in order each of the others is; -1 if it isn't there."""
    keys, key = _key(*have), _key(a, c)
    at, out = np.searchsorted(keys, key), np.full(len(key), -1)
    left = np.flatnonzero(at < len(keys))
    while len(left):
        left = left[keys[at[left]] == key[left]]
        hit = (have[0][at[left]] == a[left]) & (have[1][at[left]] == c[left])
        out[left[hit]] = at[left[hit]]
        left = left[~hit]
        at[left] += 1
        left = left[at[left] < len(keys)]
    return out


def pack(a: np.ndarray, c: np.ndarray, ids: np.ndarray) -> bytes:
    """Fingerprints in order with a document each; neighbours that share anchor and document store these once, and documents take
    four bytes where the ids lie near enough."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (ids[1:] != ids[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(a)))
    if len(n) and n.max() > 255:  # cut long runs, so that a byte holds each length
        at = np.concatenate([np.arange(s, s + k, 255) for s, k in zip(at.tolist(), n.tolist(), strict=True)])
        n = np.diff(np.append(at, len(a)))
    own = ids[at].astype(np.int64).view(U) - U(int(ids.min()) & (1 << 64) - 1) if len(a) else np.empty(0, U)
    wide = bool(len(own) and own.max() >> U(32))
    head = np.array([len(at), len(a), ids.min() if len(a) else 0, wide], np.int64)
    return b"".join((head.tobytes(), a[at].tobytes(), own.astype(U if wide else np.uint32).tobytes(), n.astype(np.uint8).tobytes(), (c >> U(16)).astype(np.uint32).tobytes(), (c & U(0xFFFF)).astype(np.uint16).tobytes()))


def unpack(data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs, total, least, wide = np.frombuffer(data, np.int64, 4)
    a = np.frombuffer(data, U, runs, 32)
    at = 32 + 8 * runs
    ids = (np.frombuffer(data, U if wide else np.uint32, runs, at).astype(U) + U(int(least) & (1 << 64) - 1)).view(np.int64)
    at += (8 if wide else 4) * runs
    n = np.frombuffer(data, np.uint8, runs, at)
    at += runs
    hi, lo = np.frombuffer(data, np.uint32, total, at), np.frombuffer(data, np.uint16, total, at + 4 * total)
    return np.repeat(a, n), (hi.astype(U) << U(16)) | lo, np.repeat(ids, n)


@dataclass(frozen=True)
class Run:
    """buckets: ranges of the anchors, a power of two; size: bytes of the texts that it stands for."""

    path: str
    level: int
    buckets: int
    size: int


@dataclass(frozen=True)
class Archive:
    """chunks: by the hash of the id; last: the largest id."""

    path: str
    chunks: int
    last: int


@dataclass
class Index:
    """What the newest manifest says. All batches of an index keep its window and anchor."""

    path: str
    window: int = 20
    anchor: int = 5
    fan_in: int = 2
    version: int = 0
    runs: list[Run] = field(default_factory=list)
    archives: list[Archive] = field(default_factory=list)

    def save(self, spark: SparkSession) -> None:
        """A new manifest. Two sessions can't both write the same version: the second one fails."""
        create_text(spark, f"{self.path}/manifest-{self.version + 1:09d}.json", json.dumps(asdict(self) | {"version": self.version + 1}))
        self.version += 1

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Index:
        """The index of a path, also one of an earlier session; wherever the folder has been moved to."""
        found = sorted(n for n in names(spark, path) if n.startswith("manifest-"))
        if not found:
            raise FileNotFoundError(f"no manifest in {path}")
        got = json.loads(read_text(spark, f"{path}/{found[-1]}"))
        return cls(**(got | {"path": path, "runs": [Run(**r) for r in got["runs"]], "archives": [Archive(**a) for a in got["archives"]]}))

    def discard(self, spark: SparkSession) -> None:
        drop_path(spark, self.path)


def _bucket(a: np.ndarray, buckets: int) -> np.ndarray:
    return ((a >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _folder(bucket: int, buckets: int) -> int:
    return bucket * min(buckets, _FOLDERS) // buckets


def _document_windows(texts: list, ids: np.ndarray, window: int, anchor: int):
    """Of each buffer of texts: which they are, the buffer, starts and ends of its words, where texts begin, and of each window
    anchor, check value, the text that it is of and its first word."""
    for lo, hi in batches(texts, SEGMENT):
        data, begins = joined(texts[lo:hi])
        starts, ends, h = words(data)
        a, c = fingerprints(h, window, anchor)
        owner = np.searchsorted(begins, starts, "right") - 1
        whole = owner[: len(a)] == owner[window - 1 :] if len(a) else np.empty(0, bool)
        yield lo, hi, data, starts, ends, begins, a[whole], c[whole], owner[: len(a)][whole], np.flatnonzero(whole)


def _read_chunk(path: str, chunk: int) -> pa.Table:
    """doc_id, text and ord of a chunk's rows, in order of the ids, null first; rows that share one in the order of their texts."""
    got = []
    for system, file in parts(f"{path}/chunk={chunk}"):
        with system.open_input_file(file) as f:
            got.append(pq.ParquetFile(f).read(["doc_id", "text"]))
    if not got:
        return pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.binary()), "ord": pa.array([], pa.int64())})
    t = pa.concat_tables(got)
    ids = t.column("doc_id").fill_null(_LEAST).to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(order) > 1 and (ids[order][1:] == ids[order][:-1]).any():
        text = t.column("text")
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], text[i].as_py() or b"")), np.int64)
    return t.append_column("ord", pa.array(ids)).take(pa.array(order))


def _chunk_rows(it, path: str, buckets: int, window: int, anchor: int):
    """For each chunk and bucket a blob of its distinct fingerprints with the least document that has each."""
    for batch in it:
        for chunk in batch.column(0).to_pylist():
            t = _read_chunk(path, chunk)
            ids, texts = t.column("ord").to_numpy(), t.column("text").to_pylist()
            found = [(x[6], x[7], ids[x[0] + x[8]]) for x in _document_windows(texts, ids, window, anchor)]
            del texts, t
            if not found:
                continue
            a, c, doc = (np.concatenate(x) for x in zip(*found, strict=True))
            del found
            order, new = _order(a, c)
            first = order[new]  # documents come in order, so the first is the least
            a, c, doc = a[first], c[first], doc[first]
            cut = np.searchsorted(_bucket(a, buckets), np.arange(buckets + 1))
            for b in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
                s = slice(cut[b], cut[b + 1])
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "chunk": [chunk], "data": pa.array([pack(a[s], c[s], doc[s])], pa.binary())})


def _read_run(run: Run, bucket: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The fingerprints of a run within bucket `bucket` of `buckets`, in order, a piece at a time."""
    span = 1 << 64
    lo, hi = bucket * span // buckets, (bucket + 1) * span // buckets - 1
    for own in range(bucket * run.buckets // buckets, max(bucket * run.buckets // buckets + 1, (bucket + 1) * run.buckets // buckets)):
        pieces = []
        for system, file in parts(f"{run.path}/kind=run/folder={_folder(own, run.buckets)}"):
            with system.open_input_file(file) as f:
                p = pq.ParquetFile(f)
                at = p.schema_arrow.get_field_index("bucket")
                for g in range(p.metadata.num_row_groups):
                    s = p.metadata.row_group(g).column(at).statistics
                    if s is None or not s.has_min_max or s.min <= own <= s.max:
                        t = p.read_row_group(g, ["bucket", "seq"])
                        pieces += [(seq, system, file, g, i) for i, (b, seq) in enumerate(zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True)) if b == own]
        held = None
        for _, system, file, g, i in sorted(pieces, key=lambda x: x[0]):
            if held is None or held[0] != (file, g):
                with system.open_input_file(file) as f:
                    held = (file, g), pq.ParquetFile(f).read_row_group(g, ["data"]).column(0)
            a, c, ids = unpack(held[1][i].as_buffer())
            if run.buckets < buckets:
                inside = (a >= U(lo)) & (a <= U(hi))
                a, c, ids = a[inside], c[inside], ids[inside]
            if len(a):
                yield a, c, ids


def _merged_row(kind: str, bucket: int, buckets: int, seq: int, archive: int | None, chunk: int | None, data: bytes) -> pa.RecordBatch:
    values = (kind, _folder(bucket, buckets) if kind == "run" else 0, bucket, seq, archive, chunk, data)
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _MERGED_ARROW, strict=True)], schema=_MERGED_ARROW)


def _run_rows(bucket: int, buckets: int, pieces) -> Iterator[pa.RecordBatch]:
    """A bucket's share of a run, from pieces in order, in rows of bounded size."""
    seq = 0
    for a, c, ids in pieces:
        for lo in range(0, len(a), _PIECE):
            s = slice(lo, lo + _PIECE)
            yield _merged_row("run", bucket, buckets, seq, None, None, pack(a[s], c[s], ids[s]))
            seq += 1


def _by_place(kind: str, bucket: int, buckets: int, archive: np.ndarray, chunk: np.ndarray, a: np.ndarray, c: np.ndarray, ids: np.ndarray):
    """A row for each place (archive and chunk), with its fingerprints in order."""
    order = np.lexsort((chunk, archive))  # stable
    archive, chunk, a, c, ids = archive[order], chunk[order], a[order], c[order], ids[order]
    edge = np.flatnonzero((archive[1:] != archive[:-1]) | (chunk[1:] != chunk[:-1])) + 1 if len(a) else []
    cut = [0, *np.asarray(edge, np.int64).tolist(), len(a)] if len(a) else [0]
    for lo, hi in zip(cut, cut[1:], strict=False):
        yield _merged_row(kind, bucket, buckets, 0, int(archive[lo]), int(chunk[lo]), pack(a[lo:hi], c[lo:hi], ids[lo:hi]))


def _merge_rows(it, buckets: int, runs: list[Run], archives: list[Archive]):
    """For each bucket: a merge join of the batch's fingerprints with each run, both in order. Gives what is new as rows of a run;
    for each chunk those of its fingerprints that another chunk or an earlier batch has first, with the document that has
    them (marks); and for the chunk of that document which of them it has to show (wants)."""
    lasts = np.array([a.last for a in archives])
    for t in groups(it, ["bucket"]):
        bucket = t.column("bucket")[0].as_py()
        got = [unpack(x.as_buffer()) for x in t.column("data")]
        chunk = np.repeat(t.column("chunk").to_numpy(), [len(x[0]) for x in got])
        a, c, doc = (np.concatenate(x) for x in zip(*got, strict=True))
        del got, t
        order = np.argsort(doc, kind="stable")
        by, new = _order(a[order], c[order])
        order = order[by]
        a, c, doc, chunk = a[order], c[order], doc[order], chunk[order]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(a)))
        ua, uc, first = a[at], c[at], doc[at].copy()
        uk = _key(ua, uc)
        old = np.zeros(len(at), bool)
        for run in runs:
            for ra, rc, ids in _read_run(run, bucket, buckets):
                ends = _key(ra[[0, -1]], rc[[0, -1]])
                lo, hi = np.searchsorted(uk, ends[0], "left"), np.searchsorted(uk, ends[1], "right")
                hit = _lookup((ra, rc), ua[lo:hi], uc[lo:hi])
                seen = np.flatnonzero(hit >= 0)
                old[lo + seen] = True
                first[lo + seen] = ids[hit[seen]]
        if (~old).any():
            yield from _run_rows(bucket, buckets, [(ua[~old], uc[~old], first[~old])])
        of = np.repeat(np.arange(len(at)), size)
        leads = new & ~old[of]  # the chunk of the first document itself
        tell = (old | (size > 1))[of] & ~leads
        yield from _by_place("mark", bucket, buckets, np.full(int(tell.sum()), len(archives) - 1), chunk[tell], a[tell], c[tell], first[of[tell]])
        wanted = old | (size > 1)
        where = np.where(old, np.searchsorted(lasts, first), len(archives) - 1)
        place = chunk[at].copy()
        for k, archive in enumerate(archives):
            mine = old & (where == k)
            place[mine] = spark_xxhash64(first[mine]) % archive.chunks
        yield from _by_place("want", bucket, buckets, where[wanted], place[wanted], ua[wanted], uc[wanted], first[wanted])


def _sorted_blobs(blobs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, c, ids = (np.concatenate(x) for x in zip(*(unpack(b) for b in blobs), strict=True))
    order, _ = _order(a, c)
    return a[order], c[order], ids[order]


def _excerpt_rows(it, archives: list[Archive], window: int, anchor: int):
    """The wanted passages of an archive's documents, each as it stands there: doc_id (order), excerpt."""
    for t in groups(it, ["archive", "chunk"]):
        archive, chunk = archives[t.column("archive")[0].as_py()], t.column("chunk")[0].as_py()
        a, c, ids = _sorted_blobs([x.as_buffer() for x in t.column("data")])
        docs = _read_chunk(archive.path, chunk)
        docs = docs.filter(pa.array(np.isin(docs.column("ord").to_numpy(), ids)))
        own, texts = docs.column("ord").to_numpy(), docs.column("text").to_pylist()
        for lo, _, data, starts, ends, _, wa, wc, who, at in _document_windows(texts, own, window, anchor):
            hit = _lookup((a, c), wa, wc)
            take = (hit >= 0) & (ids[hit] == own[lo + who])
            at, who = at[take], who[take]
            if not len(at):
                continue
            cut = np.flatnonzero((at[1:] > at[:-1] + 1) | (who[1:] != who[:-1])) + 1
            begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
            pieces = [data[s:e] for s, e in zip(starts[at[begin]].tolist(), ends[at[end] + window - 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([longs(own[lo + who[begin]]), pa.array(pieces, pa.binary())], ["first", "excerpt"])


def _mark_docs(it):
    """The documents that each chunk has to be shown something of."""
    for t in groups(it, ["chunk"]):
        ids = np.unique(np.concatenate([unpack(x.as_buffer())[2] for x in t.column("data")]))
        yield pa.RecordBatch.from_arrays([pa.array([t.column("chunk")[0].as_py()] * len(ids), pa.int64()), longs(ids)], ["chunk", "first"])


def _same_words(x: bytes, y: bytes) -> bool:
    return x == y or x.split() == y.split()


def _verified(mine: list, theirs: list, i: np.ndarray, j: np.ndarray, window: int) -> np.ndarray:
    """Whether window i of mine and window j of theirs have the same words. Windows are counted through all buffers; runs of
    neighbours on both sides are compared at once, and singly if they differ."""
    out = np.zeros(len(i), bool)
    if not len(i):
        return out
    edges = [np.cumsum([0, *(len(x[6]) for x in side)]) for side in (mine, theirs)]

    def place(side: int, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of = np.searchsorted(edges[side], windows, "right") - 1
        at = np.empty(len(windows), np.int64)
        for b in np.unique(of):
            at[of == b] = (mine, theirs)[side][b][9][windows[of == b] - edges[side][b]]
        return of, at

    (bi, wi), (bj, wj) = place(0, i), place(1, j)
    cut = np.flatnonzero((bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1]) | (wi[1:] != wi[:-1] + 1) | (wj[1:] != wj[:-1] + 1)) + 1

    def text(of: tuple, first: int, last: int) -> bytes:
        return of[2][of[3][first] : of[4][last + window - 1]]

    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(i)], strict=True):
        p, q = mine[bi[lo]], theirs[bj[lo]]
        if _same_words(text(p, wi[lo], wi[hi - 1]), text(q, wj[lo], wj[hi - 1])):
            out[lo:hi] = True
        else:
            out[lo:hi] = [_same_words(text(p, wi[k], wi[k]), text(q, wj[k], wj[k])) for k in range(lo, hi)]
    return out


def _repeated(found: list, ids: np.ndarray, marks: list, excerpts: list, window: int, anchor: int) -> np.ndarray:
    """For each window of a chunk, through its buffers, whether an earlier one has the same words: one of the chunk, or the passage
    that the first document shows. marks: blobs. excerpts: (document, bytes)."""
    a, c = np.concatenate([x[6] for x in found]), np.concatenate([x[7] for x in found])
    order, new = _order(a, c)
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    lead = np.empty(len(a), np.int64)
    lead[order] = first  # the chunk's first window of that fingerprint
    again = np.flatnonzero(lead != np.arange(len(a)))
    out = np.zeros(len(a), bool)
    out[again] = _verified(found, found, again, lead[again], window)
    for i in again[~out[again]].tolist():  # a collision: any earlier one of the fingerprint will do
        before = np.flatnonzero((a[:i] == a[i]) & (c[:i] == c[i]))
        out[i] = _verified(found, found, np.full(len(before), i), before, window).any()
    if marks and excerpts:
        ma, mc, mid = _sorted_blobs(marks)
        shown = list(_document_windows([x for _, x in excerpts], np.array([d for d, _ in excerpts], np.int64), window, anchor))
        ea, ec = np.concatenate([x[6] for x in shown]), np.concatenate([x[7] for x in shown])
        eid = np.concatenate([np.array([excerpts[k][0] for k in (x[0] + x[8]).tolist()], np.int64) for x in shown])
        by, one = _order(ea, ec)
        by = by[one]
        leads = np.flatnonzero(lead == np.arange(len(a)))
        hit = _lookup((ma, mc), a[leads], c[leads])
        leads, hit = leads[hit >= 0], hit[hit >= 0]
        own = np.concatenate([ids[x[0] + x[8]] for x in found])[leads]
        at = _lookup((ea[by], ec[by]), a[leads], c[leads])
        ok = (at >= 0) & (mid[hit] != own)
        ok[ok] = eid[by[at[ok]]] == mid[hit[ok]]
        out[leads[ok]] = _verified(found, shown, leads[ok], by[at[ok]], window)
    return out


def _apply_rows(it, archive: Archive, window: int, anchor: int, make):
    """For each chunk: which words are covered by a repeated window; make(...) gives rows."""
    for t in groups(it, ["chunk"]):
        chunk = t.column("chunk")[0].as_py()
        marks = [x.as_buffer() for x in t.column("data") if x.is_valid]
        excerpts = [(d, x) for d, x in zip(t.column("first").to_pylist(), t.column("excerpt").to_pylist(), strict=True) if x is not None]
        docs = _read_chunk(archive.path, chunk)
        if not docs.num_rows:
            continue
        ids, texts = docs.column("ord").to_numpy(), docs.column("text").to_pylist()
        found = list(_document_windows(texts, ids, window, anchor))
        again = _repeated(found, ids, marks, excerpts, window, anchor)
        done = 0
        for lo, hi, buf, starts, _, begins, a, _, _, at in found:
            covered = np.zeros(len(starts) + 1, np.int32)
            w = at[again[done : done + len(a)]]
            done += len(a)
            np.add.at(covered, w, 1)
            np.add.at(covered, w + window, -1)
            yield make(docs.slice(lo, hi - lo), buf, starts, begins, np.cumsum(covered[:-1]) > 0)


def _rest(buf: bytes, starts: np.ndarray, begins: np.ndarray, gone: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Of each text: its kept words joined by one space, its number of words and of removed words."""
    cut = np.searchsorted(starts, begins)
    out = []
    removed = np.concatenate(([0], np.cumsum(gone)))
    for i, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False)):
        of = buf[begins[i] : begins[i + 1]].split()
        out.append(b" ".join(of) if removed[lo] == removed[hi] else b" ".join([w for w, g in zip(of, gone[lo:hi].tolist(), strict=True) if not g]))
    return out, np.diff(cut), removed[cut[1:]] - removed[cut[:-1]]


def _text_rows(t, buf, starts, begins, gone):
    kept, n, r = _rest(buf, starts, begins, gone)
    ids = t.column("doc_id").combine_chunks()
    return pa.RecordBatch.from_arrays([ids, longs(n), longs(r), pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def _digest_rows(t, buf, starts, begins, gone):
    kept, n, r = _rest(buf, starts, begins, gone)
    ids = t.column("doc_id").combine_chunks()
    return pa.RecordBatch.from_arrays([ids, longs(n), longs(r), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _write_merged(rows: DataFrame, path: str) -> None:
    """Fingerprints don't compress, nor do they repeat."""
    writer = rows.write.partitionBy("kind", "folder").option("compression", "uncompressed")
    writer.option("parquet.enable.dictionary", "false").option("parquet.block.size", str(8 << 20)).parquet(path)


def _power_of_two(x: float, least: int) -> int:
    return max(least, 1 << max(0, math.ceil(math.log2(max(1.0, x)))))


def add_batch(docs: DataFrame, index: Index, digest: bool = False, chunk_bytes: int | None = None, buckets: int | None = None) -> str:
    """Remove from a batch every word covered by a window whose words occur earlier, in the batch or in the index, and add the
    batch to the index. Gives the path of a table doc_id, n_words, n_removed and kept (the words left, joined by a space) or,
    with digest, kept_sha256.

    Within a batch documents count by doc_id; those of a batch must follow those of earlier batches, or it fails. Null texts
    have no words. A null doc_id counts as the least bigint, so there may be some in the first batch only. Rows that share an id
    follow each other in the order of their texts. Very long texts are hashed in segments; a document is one worker's. Other
    columns are ignored, whatever their names. An empty batch changes nothing. Should three windows of two different word
    sequences share a fingerprint, the last of them can stay although it repeats; nothing goes that doesn't.

    chunk_bytes: of text in a chunk (2 to 16 MB by the size of the batch); buckets: ranges of fingerprints, a power of two.
    """
    spark = docs.sparkSession
    own = F.col("doc_id").cast("bigint")
    total, first, last = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.min(F.coalesce(own, F.lit(_LEAST))), F.max(F.coalesce(own, F.lit(_LEAST)))).first()
    kept = "kept_sha256" if digest else "kept"
    result, out = f"doc_id bigint, n_words bigint, n_removed bigint, {kept} string", scratch(spark, "kept")
    if last is None:
        spark.createDataFrame([], result).write.parquet(out)
        return out
    if index.archives and first <= index.archives[-1].last:
        raise ValueError(f"ids of a batch must follow {index.archives[-1].last}, the last one of the index")
    compact(spark, index)
    chunks = max(1, math.ceil(total / (chunk_bytes or min(16 << 20, max(2 << 20, total >> 10)))))
    buckets = buckets or _power_of_two(total / 6 / min(4e6, max(5e5, total / 6 / 4096)), 8)
    window, anchor = index.window, index.anchor

    texts = f"{index.path}/archive-{uuid.uuid4().hex}"
    src = docs.select(own.alias("doc_id"), F.col("text").cast("binary").alias("text"), F.pmod(F.xxhash64(F.coalesce(own, F.lit(_LEAST))), F.lit(chunks)).cast("bigint").alias("chunk"))
    src.repartition("chunk").sortWithinPartitions("chunk").write.partitionBy("chunk").option("compression", "zstd").parquet(texts)
    release_shuffles(spark)
    archive = Archive(texts, chunks, last)
    archives, runs = [*index.archives, archive], list(index.runs)
    tasks = min(chunks, 1 << 14)

    stage = f"{index.path}/run-{uuid.uuid4().hex}"
    prints = map_arrow(spark.range(0, chunks, 1, tasks), lambda it: _chunk_rows(it, texts, buckets, window, anchor), "bucket int, chunk bigint, data binary")
    merged = map_arrow(prints.repartition("bucket").sortWithinPartitions("bucket"), lambda it: _merge_rows(it, buckets, runs, archives), _MERGED)
    with settings(spark, **_SMALL):
        _write_merged(merged, stage)
    release_shuffles(spark)

    found = spark.read.schema(_MERGED).parquet(stage)
    marks, wants = found.where("kind = 'mark'"), found.where("kind = 'want'")
    places, tasks = (min(1 << 14, -(-n // 4)) for n in (sum(a.chunks for a in archives), 2 * chunks))
    wanted = wants.select("archive", "chunk", "data").repartition(places, "archive", "chunk").sortWithinPartitions("archive", "chunk")
    shown = map_arrow(wanted, lambda it: _excerpt_rows(it, archives, window, anchor), "first bigint, excerpt binary")
    by_chunk = marks.select("chunk", "data").repartition(tasks, "chunk").sortWithinPartitions("chunk")
    pairs = map_arrow(by_chunk, _mark_docs, "chunk bigint, first bigint")
    null = lambda kind: F.lit(None).cast(kind)
    rows = spark.range(chunks).select(F.col("id").alias("chunk"), null("binary").alias("data"), null("bigint").alias("first"), null("binary").alias("excerpt"))
    rows = rows.unionByName(marks.select("chunk", "data"), allowMissingColumns=True).unionByName(pairs.join(shown, "first"), allowMissingColumns=True)
    rows = rows.repartition(tasks, "chunk").sortWithinPartitions("chunk")
    make = _digest_rows if digest else _text_rows
    with settings(spark, **_SMALL):
        map_arrow(rows, lambda it: _apply_rows(it, archive, window, anchor, make), result).write.parquet(out)
    for kind in ("mark", "want"):
        drop_path(spark, f"{stage}/kind={kind}")
    release_shuffles(spark)
    index.runs.append(Run(stage, 0, buckets, total))
    index.archives.append(archive)
    index.save(spark)
    return out


def _streamed_merge(streams: list[Iterator]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One stream of fingerprints in order out of several, of which a piece each is held."""
    held = [next(s, None) for s in streams]
    while any(h is not None for h in held):
        ends = [_key(h[0][-1:], h[1][-1:])[0] for h in held if h is not None]
        bound, out = min(ends), []
        for k, h in enumerate(held):
            if h is None:
                continue
            n = int(np.searchsorted(_key(h[0], h[1]), bound, "right"))
            out.append(tuple(x[:n] for x in h))
            held[k] = tuple(x[n:] for x in h) if n < len(h[0]) else next(streams[k], None)
            while held[k] is not None and (n := int(np.searchsorted(_key(*held[k][:2]), bound, "right"))):  # the key goes on in the next piece
                out.append(tuple(x[:n] for x in held[k]))
                held[k] = tuple(x[n:] for x in held[k]) if n < len(held[k][0]) else next(streams[k], None)
        a, c, ids = (np.concatenate(x) for x in zip(*out, strict=True))
        order, _ = _order(a, c)
        yield a[order], c[order], ids[order]


def _compacted(it, buckets: int, runs: list[Run]):
    for batch in it:
        for bucket in batch.column(0).to_pylist():
            yield from _run_rows(bucket, buckets, _streamed_merge([_read_run(run, bucket, buckets) for run in runs]))


def compact(spark: SparkSession, index: Index) -> None:
    """Merge the newest runs while `fan_in` of them are of one level. Runs hold disjoint fingerprints, so that a merge of
    sorted runs neither finds nor drops doubles; it reads no texts, and runs without fingerprints merge into one without. Buckets are
    split where the new run is too large for those of the old ones. The old runs go only when the manifest names the new one; what a
    merge or a batch that was cut off has written is in no manifest and does no harm."""
    while len(index.runs) >= index.fan_in and len({r.level for r in index.runs[-index.fan_in :]}) == 1:
        old = index.runs[-index.fan_in :]
        size = sum(r.size for r in old)
        buckets, path = max(_power_of_two(size / 6 / 4e6, 8), *(r.buckets for r in old)), f"{index.path}/run-{uuid.uuid4().hex}"
        rows = map_arrow(spark.range(0, buckets, 1, min(buckets, 1 << 14)), lambda it: _compacted(it, buckets, old), _MERGED)
        with settings(spark, **_SMALL):
            _write_merged(rows, path)
        index.runs[-index.fan_in :] = [Run(path, old[0].level + 1, buckets, size)]
        index.save(spark)
        for run in old:
            drop_path(spark, run.path)


def substring_dedup(docs: DataFrame, batches_: int = 4, digest: bool = False, window: int = 20) -> DataFrame:
    """The whole table as `batches_` batches in order of doc_id, each added to one index. See add_batch for the columns
    and for nulls, ties, very long texts and empty tables."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx("doc_id", [k / batches_ for k in range(1, batches_)], 10_000) if batches_ > 1 else F.lit(None)).first()
    bounds = sorted(set(cuts[0] or []))
    index = Index(scratch(spark, "index"), window=window, anchor=min(5, window))
    out = []
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST))
    for lo, hi in zip([None, *bounds], [*bounds, None], strict=True):
        part = docs.where((F.lit(True) if lo is None else key > lo) & (F.lit(True) if hi is None else key <= hi))
        out.append(add_batch(part, index, digest))
    index.discard(spark)
    kept = "kept_sha256" if digest else "kept"
    return spark.read.schema(f"doc_id bigint, n_words bigint, n_removed bigint, {kept} string").parquet(*out)
