"""Helpers for functions that Spark calls with iterators of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_MOST = 8 << 20


def map_arrow(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """df.mapInArrow with batches of 8 MB at most, for this session from now on: whole texts in batches by rows alone would take
    hundreds of megabytes on both sides."""
    now = df.sparkSession.conf.get(_BATCH, None) or ""
    size = int(now.removesuffix("b")) if now.removesuffix("b").lstrip("-").isdigit() else _MOST + 1
    if not 0 < size <= _MOST:
        df.sparkSession.conf.set(_BATCH, str(_MOST))
    return df.mapInArrow(make, schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of equal keys, from batches that are sorted by them. Keys are integers without nulls."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in columns:
            cut[1:] |= c[1:] != c[:-1]
        if last is not None and any(c[0] != x for c, x in zip(columns, last, strict=True)):
            yield pa.Table.from_batches(held)
            held = []
        last = [c[-1] for c in columns]
        at = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for lo, hi in zip(at, at[1:], strict=False):
            if lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def longs(x: np.ndarray) -> pa.Array:
    """64-bit values as Spark's signed bigint, bit for bit."""
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def lists(x: np.ndarray) -> pa.Array:
    """A matrix of 64-bit values as one list for each row."""
    rows, width = x.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * np.int32(width))
    return pa.ListArray.from_arrays(offsets, longs(np.ascontiguousarray(x).reshape(-1)))
