"""Removal of lines that many documents share, by range-partitioned hashes and per-document keep bitmaps.

Only hashes, ids and positions travel: (hash of the line's key, document, position) is range-partitioned by all of these
and sorted within each partition, so a line that a third of all documents hold spreads over many partitions. Each
partition streams its rows once. A group that begins and ends inside one is settled there; of the first and the last
group, which may go on next door, the rows are passed on and settled with a summary of two keys a partition at most. The
dropped positions become one compressed bitmap for each document, and only these meet the texts again.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlewright.llm.arrow import longs, map_arrow
from titlewright.session import discard, materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"
_COLUMNS = ["h1", "h2", "doc_id", "text_key", "pos"]


def line_rows(docs: DataFrame, least_chars: int) -> DataFrame:
    """Key hash (128 bits), doc_id, a hash of the document's text and position of every line with a long enough key."""
    lines = docs.where("doc_id is not null").select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(_SPACE)), _UPPER, _LOWER)
    long = lines.where(F.char_length("line") >= least_chars).select("doc_id", "text_key", "pos", key.alias("key")).where(F.char_length("key") >= least_chars)
    return long.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(0x5BD1E995), "key").alias("h2"), "doc_id", "text_key", F.col("pos").cast("bigint").alias("pos"))


def _drop_mask(x: list[np.ndarray], least_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted rows: where groups begin, the number of documents of each, and whether a row is to be dropped."""
    h1, h2, doc = x[:3]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    at = np.flatnonzero(new)
    first_of_doc = new.copy()
    first_of_doc[1:] |= doc[1:] != doc[:-1]
    docs = np.add.reduceat(first_of_doc.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
    group = np.cumsum(new) - 1
    return at, docs, (docs[group] >= least_docs) & (doc != doc[at][group])


def _rows(kind: str, x: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(x[0]), pa.string()), *map(longs, x)], ["kind", *_COLUMNS])


def _stream(it, least_docs: int):
    """Of one sorted partition: rows to drop, and the rows of its first and last group, kind edge, to be settled later.

    Of a last group that has shown enough documents the rows go out at once; a row for each of its first documents is
    passed on for the sake of the next partition. So no more than the rows of `least_docs` documents are ever held.
    """
    held: list[np.ndarray] | None = None
    edge: tuple | None = None  # the partition's first group
    big: tuple | None = None  # an open group with enough documents: its key and its first document
    for batch in it:
        if not batch.num_rows:
            continue
        x = [batch.column(c).to_numpy() for c in _COLUMNS]
        edge = edge or (x[0][0], x[1][0])
        for key, kind in ((edge, "edge"), (big, "drop")):
            if key and x and (same := (x[0] == key[0]) & (x[1] == key[1])).any() and (kind == "edge" or edge != key[:2]):
                yield _rows(kind, [c[same & ((kind == "edge") | (x[2] != key[-1]))] for c in x])
                x = [c[~same] for c in x]
        if not len(x[0]):
            continue
        if held is not None:
            x = [np.concatenate(c) for c in zip(held, x, strict=True)]
        at, docs, drop = _drop_mask(x, least_docs)
        last = at[-1]
        if (done := drop[:last]).any():
            yield _rows("drop", [c[:last][done] for c in x])
        held = [c[last:] for c in x]
        if docs[-1] >= least_docs:
            big = (held[0][0], held[1][0], held[2][0])
            yield _rows("drop", [c[drop[last:]] for c in held])
            once = np.unique(held[2], return_index=True)[1]
            yield _rows("edge", [c[np.sort(once)[:least_docs]] for c in held])
            held = None
        else:
            big = None
    if held is not None:
        yield _rows("edge", held)


def _bitmap_rows(it):
    for batch in it:
        maps = []
        for p in batch.column("positions").to_pylist():
            keep = np.ones((max(p) + 8) // 8 * 8, bool)
            keep[p] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(maps, pa.binary())], ["doc_id", "text_key", "bitmap"])


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, text_key, bitmap of the documents that lose lines. A bitmap is packed bits, one for each line up to the
    last that goes (1: stays) in whole bytes, compressed with zlib; lines beyond it stay."""
    lines = materialize(line_rows(docs, least_chars), "lines")
    order = ["h1", "h2", F.desc("doc_id"), "pos", "text_key"]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    longs_ = ", ".join(f"{c} bigint" for c in _COLUMNS)
    seen = materialize(map_arrow(dealt, lambda it: _stream(it, least_docs), f"kind string, {longs_}"), "seen")
    discard(lines)
    edge = seen.where("kind = 'edge'")
    once = edge.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    # Two keys a partition at most, whatever the input.
    wide = once.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= least_docs)
    late = edge.join(F.broadcast(wide), ["h1", "h2"]).where("doc_id <> last")
    gone = seen.where("kind = 'drop'").select("doc_id", "text_key", "pos").unionByName(late.select("doc_id", "text_key", "pos"))
    per = gone.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("positions"))
    return map_arrow(per, _bitmap_rows, "doc_id bigint, text_key bigint, bitmap binary")


def _kept_lines(text: bytes | None, bitmap: bytes | None) -> tuple[bytes, int, int]:
    if bitmap is None:
        return text or b"", (text or b"").count(b"\n") + 1, 0
    lines = (text or b"").split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(lines)].tolist()
    keep += [1] * (len(lines) - len(keep))
    kept = [x for x, k in zip(lines, keep, strict=True) if k]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _apply(it, digest: bool):
    for batch in it:
        got = [_kept_lines(t, b) for t, b in zip(batch.column("raw").to_pylist(), batch.column("bitmap").to_pylist(), strict=True)]
        if digest:
            kept = pa.array([hashlib.sha256(x[0]).hexdigest() for x in got], pa.string())
        else:  # a null text stays null
            kept = pa.array([None if null else x[0].decode("utf-8", "replace") for x, null in zip(got, batch.column("raw").is_null().to_pylist(), strict=True)], pa.string())
        rest = [batch.column(c) for c in batch.schema.names if c not in ("raw", "bitmap")]
        names = [c for c in batch.schema.names if c not in ("raw", "bitmap")]
        yield pa.RecordBatch.from_arrays([*rest, longs(np.array([x[1] for x in got])), longs(np.array([x[2] for x in got])), kept], [*names, "n_lines", "n_dropped", "kept"])


def line_dedup(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, digest: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the carried columns, n_lines, n_dropped and kept (the lines left, or with digest their SHA-256).

    Lines end at \\n only. A null or empty text is one empty line. Documents are counted by doc_id; rows that repeat an id
    with the same text are treated alike, rows of one id with different texts count as one document and each keep or lose
    their own lines. Rows with a null id take no part and lose nothing. Carried columns of the result's names stand beside these,
    other columns are ignored. A text, however long, is one worker's. An empty table gives no rows.
    """
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text", *[F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)])
    maps = keep_bitmaps(src.select("doc_id", "text_key", "text"), least_chars, least_docs)
    both = src.join(maps, ["doc_id", "text_key"], "left").withColumn("raw", F.col("text").cast("binary")).drop("text_key", "text")
    made = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())]
    out = map_arrow(both, lambda it: _apply(it, digest), T.StructType([*(f for f in both.schema if f.name not in ("raw", "bitmap")), *made]))
    return out.select("doc_id", *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)], "n_lines", "n_dropped", F.col("kept").alias("kept_sha256") if digest else F.col("kept"))
