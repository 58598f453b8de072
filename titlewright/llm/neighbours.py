"""Approximate nearest neighbours by inner product: cross-polytope hashing, multiprobe tables and exact reranking.

Each table turns a vector by rounds of random signs and Hadamard transforms, as often as the table has components, and takes
the nearest signed axis in each; the axes together are its cell. There are as many components, the last of them of as many
axes, as make two to four times as many cells as there are vectors, so cells don't grow with the table. Candidates are hashed in bands of similar length, by direction: within a
band the nearest direction is nearly the largest inner product. A band of few rows is one cell that every query visits. A
query visits the cells whose axes it is nearest to, the same share of all cells in each table. That share is measured: a bounded
sample of queries is scored against all rows, and it is the least one that finds the wanted part of their neighbours.

Cells that follow each other are a slice, and a query goes once to each slice that it may visit, with how near a cell has to be;
which cells these are is found where the slice is scored, since their list grows with the table. Slices
are dealt out in blocks of bounded size on both sides, so no cell is capped and none has to fit in a task. Every candidate found
is scored exactly; a query that finds too few is scored against all rows. Tables that would take too much to shuffle at once go a
few at a time, and what a query has found by then is the least that later ones have to reach.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlewright.llm.arrow import groups, longs, map_arrow
from titlewright.session import discard, materialize, release_shuffles

#: The slice of the rows that every query meets.
_ALL = -1
_SLICES = 1 << 24
_LAST = 2048
_BINS = 256


@dataclass(frozen=True)
class Tables:
    """tables: hash tables. recall: part of the sample's neighbours that the visited cells have to hold; sample: queries that it is
    measured on. bands: of lengths, at most. whole: rows of a band that isn't hashed. parts: components, at most. slice_rows, block and query_block: rows of
    a slice on average, candidates and queries of a block at most. round_bytes: of candidates that are dealt out at once, if one table allows it."""

    tables: int = 20
    recall: float = 0.98
    sample: int = 64
    bands: int = 12
    whole: int = 512
    parts: int = 4
    slice_rows: int = 32_768
    block: int = 65_536
    query_block: int = 32_768
    round_bytes: int = 1 << 30
    seed: int = 7


def _butterflies(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each column, whose length is a power of two, in n log n steps of whole rows."""
    n, other = len(x), np.empty_like(x)
    h = 1
    while h < n:
        pairs, out = x.reshape(n // (2 * h), 2, h, -1), other.reshape(n // (2 * h), 2, h, -1)
        np.add(pairs[:, 0], pairs[:, 1], out=out[:, 0])
        np.subtract(pairs[:, 0], pairs[:, 1], out=out[:, 1])
        x, other = other, x
        h *= 2
    return x


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal transform of each row."""
    return _butterflies(np.ascontiguousarray(x.T)).T / np.sqrt(x.shape[1])


def _axes(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


@dataclass(frozen=True)
class Band:
    """How a band of lengths is hashed: its number, the axes of each component, and slices."""

    number: int
    axes: tuple[int, ...]
    slices: int

    @property
    def cells(self) -> int:
        return math.prod(2 * n for n in self.axes)


def _band(number: int, rows: int, dim: int, cfg: Tables) -> Band:
    n, axes, cells = _axes(dim), [], 1
    while cells < 2 * rows and len(axes) < cfg.parts:
        axes.append(min(n, 1 << max(0, (-(-rows // cells) - 1).bit_length())))
        cells *= 2 * axes[-1]
    return Band(number, tuple(axes), max(1, min(cells, rows // cfg.slice_rows)))


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1))[:, None]


def turned(x: np.ndarray, axes: tuple[int, ...], cfg: Tables, only: int | None = None):
    """For each table, or only one, the directions of x, filled up with zeros to a power of two and turned, once for each
    component: signed axes as columns, as many of them as the component has."""
    n = _axes(x.shape[1])
    wide = np.zeros((n, len(x)), np.float32)
    wide[: x.shape[1]] = _directions(x).T
    for t in range(cfg.tables) if only is None else (only,):
        out = []
        for part, some in enumerate(axes):
            y = wide
            for signs in np.random.default_rng((cfg.seed, t, part)).integers(0, 2, (3, n, 1)).astype(np.float32) * 2 - 1:
                y = _butterflies(y * signs)
            near = y[:some].T * np.float32(n**-1.5)
            out.append(np.concatenate((near, -near), 1))
        yield out


def _cells(x: np.ndarray, band: Band, cfg: Tables) -> np.ndarray:
    """The cell of each row in each table."""
    out = []
    for parts in turned(x, band.axes, cfg):
        cell = np.zeros(len(x), np.int64)
        for y in parts:
            cell = cell * y.shape[1] + y.argmax(1)
        out.append(cell)
    return np.stack(out, 1)


def _halves(parts: list[np.ndarray], row: int) -> tuple[np.ndarray, np.ndarray]:
    """A query's scores of the first and the last components' cells; a cell's score is the sum of one of each."""
    middle = len(parts) - 1
    while middle > 1 and math.prod(y.shape[1] for y in parts[middle - 1 :]) <= _LAST:
        middle -= 1
    out = []
    for some in (parts[:middle], parts[middle:]):
        total = np.zeros(1)
        for y in some:
            total = (total[:, None] + y[row][None, :]).reshape(-1)
        out.append(total)
    return out[0], out[1]


def _level(a: np.ndarray, b: np.ndarray, n: int) -> float:
    """How near a query's n nearest cells are, by the scores of their halves, less at most 1/256 of the range."""
    width = (np.ptp(a) + np.ptp(b)) / (_BINS - 1) + 1e-300
    counts = np.convolve(*(np.bincount(((x - x.min()) / width).astype(np.int64), minlength=_BINS) for x in (a, b)))
    enough = np.flatnonzero(np.cumsum(counts[::-1]) >= n)
    return float(a.min() + b.min() + (len(counts) - 1 - enough[0]) * width - 1e-12) if len(enough) else -math.inf


def _near(a: np.ndarray, b: np.ndarray, level: float, first: int, last: int) -> np.ndarray:
    """The cells from first to last that are as near to a query as level."""
    from_, to = first // len(b), last // len(b) + 1
    order = from_ + np.flatnonzero(a[from_:to] >= level - b.max() - 1e-12)
    high = np.argsort(b)
    begin = np.searchsorted(b[high], level - a[order], "left")
    many = len(b) - begin
    at = np.arange(many.sum()) + np.repeat(begin - np.concatenate(([0], np.cumsum(many)[:-1])), many)
    cells = np.sort(np.repeat(order * len(b), many) + high[at])
    return cells[np.searchsorted(cells, first, "left") : np.searchsorted(cells, last, "right")]


def _visited(parts: list[np.ndarray], row: int, n: int) -> np.ndarray:
    """The n cells that a query is nearest to, and those that are as near as the last of them but for 1/256 of the range."""
    a, b = _halves(parts, row)
    return _near(a, b, _level(a, b, n), 0, len(a) * len(b) - 1)


def _met(a: np.ndarray, b: np.ndarray, level: float, band: Band) -> np.ndarray:
    """The slices of a table that may have cells as near as level."""
    if band.slices == 1:
        return np.zeros(1, np.int64)
    # A slice has whole runs of the first components' cells, and parts of one at either end.
    cut = np.arange(band.slices + 1) * (band.cells / band.slices) / len(b)
    pairs = np.stack((np.maximum(np.floor(cut[:-1]) - 1, 0), np.minimum(np.floor(cut[1:]) + 2, len(a))), 1).astype(np.int64)
    most = np.maximum.reduceat(np.append(a, -np.inf), pairs.reshape(-1))[::2]
    return np.flatnonzero(most >= level - b.max() - 1e-12)


def _rank_shares(queries: np.ndarray, owner: np.ndarray, neighbours: np.ndarray, band: Band, cfg: Tables) -> np.ndarray:
    """For each neighbour the least share of cells, over the tables, that its query (owner) has to visit to meet it."""
    out = np.ones(len(neighbours))
    for own, parts in zip(_cells(neighbours, band, cfg).T, turned(queries, band.axes, cfg), strict=True):
        for q in np.unique(owner):
            a, b = _halves(parts, q)
            high = np.sort(a)
            for i in np.flatnonzero(owner == q):
                level = a[own[i] // len(b)] + b[own[i] % len(b)] - 1e-12
                out[i] = min(out[i], (len(a) - np.searchsorted(high, level - b, "left")).sum() / band.cells)
    return out


def _bands(counts: dict[int, int], cfg: Tables) -> dict[int, int]:
    """The band of each exponent of squared lengths, the longest first; _ALL for those of few rows. The last takes the rest."""
    out, used = {}, 0
    for e in sorted(counts, reverse=True):
        if counts[e] <= cfg.whole and used < cfg.bands:
            out[e] = _ALL
        else:
            used += used < cfg.bands
            out[e] = used - 1
    return out


def _slice(band: Band, table: int, cell: np.ndarray, cfg: Tables) -> np.ndarray:
    at = (cell.astype(np.float64) * (band.slices / band.cells)).astype(np.int64)
    return (band.number * cfg.tables + table) * _SLICES + np.minimum(at, band.slices - 1)


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim).astype(np.float64)


_HASHED = "vec_id bigint, vec binary, places array<struct<slice:bigint,cell:bigint,level:double>>"


def _places(where: np.ndarray, cells: np.ndarray, levels: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The column places: counts says how many each row has."""
    each = pa.StructArray.from_arrays([longs(where), longs(cells), pa.array(levels)], ["slice", "cell", "level"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), each)


def _hash_rows(it, cfg: Tables, dim: int, band_of: dict[int, int], bands: list[Band], kind: str):
    """Each row with its slice and cell in each table; rows of a band of few rows with the slice of all."""
    for batch in it:
        x = _matrix(batch.column("vec"), kind, dim)
        own = np.array([band_of[e] for e in batch.column("exponent").to_pylist()], np.int64)
        for lo in range(0, len(x), 2048):
            for number in np.unique(own[lo : lo + 2048]).tolist():
                at = lo + np.flatnonzero(own[lo : lo + 2048] == number)
                if number == _ALL:
                    where, cells = np.full((len(at), 1), _ALL), np.zeros((len(at), 1), np.int64)
                else:
                    cells = _cells(x[at], bands[number], cfg)
                    where = np.stack([_slice(bands[number], t, cells[:, t], cfg) for t in range(cfg.tables)], 1)
                n, width = where.shape
                places = _places(where.reshape(-1), np.ascontiguousarray(cells).reshape(-1), np.zeros(n * width), np.full(n, width))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), batch.column("vec").take(pa.array(at)), places], ["vec_id", "vec", "places"])


def _probe_rows(it, cfg: Tables, dim: int, bands: list[Band], any_whole: bool, kind: str, share: float):
    """Each query with every slice that it may visit and how near a cell has to be there."""
    for batch in it:
        x = _matrix(batch.column("vec"), kind, dim)
        for lo in range(0, len(x), 128):
            some = x[lo : lo + 128]
            own: list[list] = [[np.array([_ALL])] if any_whole else [] for _ in some]
            near: list[list] = [[np.zeros(1)] if any_whole else [] for _ in some]
            for band in bands:
                n = max(1, math.ceil(share * band.cells))
                for t, parts in enumerate(turned(some, band.axes, cfg)):
                    for i in range(len(some)):
                        a, b = _halves(parts, i)
                        level = _level(a, b, n)
                        met = _met(a, b, level, band)
                        own[i].append((band.number * cfg.tables + t) * _SLICES + met)
                        near[i].append(np.full(len(met), level))
            counts = np.array([sum(map(len, x)) for x in own], np.int64)
            where, levels = (np.concatenate([y for x in many for y in x] or [np.zeros(0)]) for many in (own, near))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").slice(lo, 128), batch.column("vec").slice(lo, 128), _places(where, np.zeros(len(where), np.int64), levels, counts)], ["vec_id", "vec", "places"])


def _vector_rows(it, dim: int, kind: str):
    """The vectors that take part, as bytes, with the binary exponents of their squared lengths, times 1.5 so that lengths near a
    power of two, as of unit vectors, aren't parted."""
    for batch in it:
        ids, column = batch.column(0), batch.column(1)
        keep, vecs, exponents = [], [], []
        for i, v in enumerate(column):
            if not v.is_valid or not ids[i].is_valid or len(v.values) != dim or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False)
            if np.isfinite(x).all() and (most := float(np.abs(x.astype(np.float64)).max())) > 0:
                keep.append(i)
                vecs.append(x.astype(kind).tobytes())
                scale = int(np.frexp(most)[1])
                exponents.append(int(np.frexp(1.5 * (np.ldexp(x.astype(np.float64), -scale) ** 2).sum())[1]) + 2 * scale)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep, pa.int64())), pa.array(vecs, pa.binary()), pa.array(exponents, pa.int32())], ["vec_id", "vec", "exponent"])


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k best, of rows that share an id the best one only. What isn't a number comes last."""
    order = np.lexsort((ids, -np.nan_to_num(score, nan=-np.inf, posinf=np.inf, neginf=-np.inf)))
    return order[np.sort(np.unique(ids[order], return_index=True)[1])[:k]]


def _best(q: np.ndarray, own: int, c: np.ndarray, ids: np.ndarray, k: int, most: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of a query's k best candidates that reach the floor, if it has one; `most` rows at most share an id. Sums are
    the same for equal vectors, wherever they stand; of many candidates those that can't be among the best go by a rough product first."""
    near = np.flatnonzero(ids != own)
    many = (k + 1) * most
    if len(near) > 4 * many:
        with np.errstate(all="ignore"):
            rough, slack = c[near] @ q, 1e-9 * (1 + np.sqrt((c[near] ** 2).sum(1).max())) * (1 + np.sqrt((q * q).sum()))
        if np.isfinite(slack) and np.isfinite(rough).all():
            near = near[rough >= max(floor, np.partition(rough, len(rough) - many)[len(rough) - many]) - slack]
    with np.errstate(all="ignore"):
        exact = (c[near] * q).sum(1)
    if floor > -math.inf:
        near, exact = near[exact >= floor], exact[exact >= floor]
    best = _top(exact, ids[near], k)
    return ids[near][best], exact[best]


def _score_rows(it, dim: int, kind: str, k: int, bands: list[Band], cfg: Tables):
    """Of each block of a slice, each query's k best candidates in the cells that it visits, packed."""
    for t in groups(it, ["slice", "db", "qb"]):
        query = t.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        if not query.any() or query.all():
            continue
        at = t.column("slice")[0].as_py()
        whole = at == _ALL
        data, asks = t.filter(pa.array(~query)), t.filter(pa.array(query))
        cell = data.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, ids, c = cell[order], data.column("vec_id").to_numpy()[order], _matrix(data.column("vec"), kind, dim)[order]
        most = int(np.unique(ids, return_counts=True)[1].max())
        owners, levels, floors = (asks.column(x).to_numpy() for x in ("vec_id", "level", "floor"))
        first, last = int(cell[0]), int(cell[-1])
        near = not whole and last - first < 8 * len(cell) + 1024  # cells are dense enough for a table of where each begins
        begins = np.searchsorted(cell, first + np.arange(last - first + 2)) if near else None
        got, out_ids, out_scores = [], [], []
        for lo in range(0, len(owners), 1024):
            q = _matrix(asks.column("vec").slice(lo, 1024), kind, dim)
            if not whole:
                parts = next(turned(q, bands[at // _SLICES // cfg.tables].axes, cfg, at // _SLICES % cfg.tables))
            for i, own in enumerate(owners[lo : lo + 1024].tolist()):
                if whole:
                    rows = slice(None)
                else:
                    visit = _near(*_halves(parts, i), levels[lo + i], first, last)
                    begin, end = (begins[visit - first], begins[visit - first + 1]) if near else (np.searchsorted(cell, visit, "left"), np.searchsorted(cell, visit, "right"))
                    n = int((end - begin).sum())
                    if not n:
                        continue
                    rows = np.repeat(begin - np.concatenate(([0], np.cumsum(end - begin)[:-1])), end - begin) + np.arange(n)
                found, score = _best(q[i], own, c[rows], ids[rows], k, most, floors[lo + i])
                if len(found):
                    got.append(own)
                    out_ids.append(found.astype(np.int64).tobytes())
                    out_scores.append(score.tobytes())
        yield pa.RecordBatch.from_arrays([longs(np.array(got, np.int64)), pa.array(out_ids, pa.binary()), pa.array(out_scores, pa.binary())], ["query_id", "ids", "scores"])


_PACKED = "query_id bigint, ids binary, scores binary"


def _packed_rows(it, k: int):
    """The k best that each query has found so far, packed, and the least score that a better one needs."""
    for t in groups(it, ["query_id"]):
        ids = np.frombuffer(b"".join(t.column("ids").to_pylist()), np.int64)
        score = np.frombuffer(b"".join(t.column("scores").to_pylist()), np.float64)
        best = _top(score, ids, k)
        last = float(score[best[-1]]) if len(best) == k else -math.inf
        columns = [t.column("query_id")[:1].combine_chunks(), pa.array([ids[best].tobytes()]), pa.array([score[best].tobytes()]), pa.array([-math.inf if math.isnan(last) else last])]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "ids", "scores", "floor"])


def _merge_rows(it, k: int):
    for t in groups(it, ["query_id"]):
        ids = np.frombuffer(b"".join(t.column("ids").to_pylist()), np.int64)
        score = np.frombuffer(b"".join(t.column("scores").to_pylist()), np.float64)
        best = _top(score, ids, k)  # repeated rows of one vec_id are one candidate, with its best score
        n = len(best)
        q = t.column("query_id")[0].as_py()
        yield pa.RecordBatch.from_arrays([pa.array([q] * n, pa.int64()), pa.array(range(1, n + 1), pa.int32()), longs(ids[best]), pa.array(score[best])], ["query_id", "rank", "vec_id", "score"])


def _truth_rows(it, sample: list[tuple[int, bytes]], dim: int, kind: str, k: int):
    """Each sampled query's k best rows of a part of the table."""
    q = np.frombuffer(b"".join(v for _, v in sample), kind).reshape(len(sample), dim).astype(np.float64)
    held: list[list] = [[] for _ in sample]

    def cut(rows: list) -> list:
        best = _top(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int64), k)
        return [rows[i] for i in best]

    for batch in it:
        if not batch.num_rows:
            continue
        x, ids, vecs = _matrix(batch.column("vec"), kind, dim), batch.column("vec_id").to_numpy(), batch.column("vec")
        for i, (own, _) in enumerate(sample):
            with np.errstate(all="ignore"):
                score = np.where(ids == own, np.nan, (x @ q[i]))
            top = np.argpartition(-np.nan_to_num(score, nan=-np.inf), min(4 * k, len(score) - 1))[: 4 * k]
            held[i] = cut(held[i] + [(float(score[j]), int(ids[j]), vecs[j].as_py(), batch.column("exponent")[j].as_py()) for j in top.tolist() if ids[j] != own])
    for i, rows in enumerate(held):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.int32())], ["query", "score", "vec_id", "vec", "exponent"])


def _measured_share(base: DataFrame, queries: DataFrame, band_of: dict[int, int], bands: list[Band], dim: int, kind: str, k: int, cfg: Tables) -> float:
    """The least share of cells that holds cfg.recall of the true neighbours of cfg.sample queries."""
    sample = [(r[0], bytes(r[1])) for r in queries.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec_id", "vec").limit(cfg.sample).collect()]
    if not sample or not bands:
        return 1.0
    found = map_arrow(base, lambda it: _truth_rows(it, sample, dim, kind, k), "query int, score double, vec_id bigint, vec binary, exponent int")
    best = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id", "vec", "exponent")), False), 1, k).alias("best"))
    rows = [(r[0], b) for r in best.collect() for b in r[1]]  # k for each sampled query
    q = np.frombuffer(b"".join(v for _, v in sample), kind).reshape(len(sample), dim).astype(np.float64)
    shares = [np.zeros(sum(band_of[b["exponent"]] == _ALL for _, b in rows))]
    for band in bands:
        mine = [(i, bytes(b["vec"])) for i, b in rows if band_of[b["exponent"]] == band.number]
        if mine:
            shares.append(_rank_shares(q, np.array([i for i, _ in mine]), np.frombuffer(b"".join(v for _, v in mine), kind).reshape(-1, dim).astype(np.float64), band, cfg))
    every = np.sort(np.concatenate(shares))
    return float(every[min(len(every) - 1, math.ceil(cfg.recall * len(every)) - 1)]) if len(every) else 1.0


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, cfg: Tables | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors found for each row whose vec_id is divisible by `every`, or all others
    if there are fewer.

    vectors: vec_id and embedding (array of float or double); other columns are ignored, whatever their names. Nearness is the
    inner product in double precision; ties go to the smaller vec_id; a query is no candidate of its own. Vectors that are
    null, zero, of another length than most, or hold null or non-finite components take no part, nor do rows without an id. A
    product that isn't a number comes last. Repeated rows count once, with their best score. An empty table gives no rows.
    """
    cfg = cfg or Tables()
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    src = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    lengths = src.where("embedding is not null").groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    dim = most[0] if most else 1
    base = materialize(map_arrow(src, lambda it: _vector_rows(it, dim, kind), "vec_id bigint, vec binary, exponent int"), "vectors")
    # A row for each exponent: about 4,300 at most.
    counts = dict(map(tuple, base.groupBy("exponent").count().collect()))
    band_of = _bands(counts, cfg)
    sizes = {b: sum(n for e, n in counts.items() if band_of[e] == b) for b in set(band_of.values()) - {_ALL}}
    bands = [_band(b, sizes[b], dim, cfg) for b in sorted(sizes)]
    queries = base.where(F.pmod("vec_id", F.lit(every)) == 0)
    share = _measured_share(base, queries, band_of, bands, dim, kind, k, cfg)
    any_whole = _ALL in band_of.values()
    data = materialize(map_arrow(base, lambda it: _hash_rows(it, cfg, dim, band_of, bands, kind), _HASHED), "hashed")
    asks = materialize(map_arrow(queries, lambda it: _probe_rows(it, cfg, dim, bands, any_whole, kind, share), _HASHED), "probing")

    def found(data: DataFrame, asks: DataFrame) -> DataFrame:
        # A row for each slice: far fewer than there are vectors. Spark broadcasts it if it is small.
        count = lambda df, block, name: df.select(F.explode("places.slice").alias("slice")).groupBy("slice").agg(F.ceil(F.count("*") / block).alias(name))
        row = lambda df, query, floor: df.select("vec_id", "vec", F.lit(query).alias("is_query"), floor.alias("floor"), F.inline("places"))
        blocks = count(data, cfg.block, "nd").join(count(asks, cfg.query_block, "nq"), "slice")
        spread, zero = F.xxhash64("vec_id"), F.lit(0).cast("bigint")
        held = row(data, False, F.lit(-math.inf)).join(blocks, "slice").withColumn("db", F.pmod(spread, "nd")).withColumn("qb", F.explode(F.sequence(zero, F.col("nq") - 1)))
        asked = row(asks, True, F.col("floor")).join(blocks, "slice").withColumn("db", F.explode(F.sequence(zero, F.col("nd") - 1))).withColumn("qb", F.pmod(spread, "nq"))
        columns = ["slice", "db", "qb", "is_query", "vec_id", "vec", "cell", "level", "floor"]
        dealt = held.select(*columns).unionByName(asked.select(*columns)).repartition("slice", "db", "qb").sortWithinPartitions("slice", "db", "qb")
        return map_arrow(dealt, lambda it: _score_rows(it, dim, kind, k, bands, cfg), _PACKED)

    def by_query(rows: DataFrame) -> DataFrame:
        return rows.repartition("query_id").sortWithinPartitions("query_id")

    def ranked(data: DataFrame, asks: DataFrame, rounds: list[range]) -> DataFrame:
        """What the queries find in each round's tables; the slice of all belongs to the first."""
        none, so_far = F.lit(-math.inf), None
        for n, tables in enumerate(rounds):
            table = lambda p: F.when(p["slice"] == _ALL, F.lit(0)).otherwise(F.shiftright(p["slice"], _SLICES.bit_length() - 1) % cfg.tables)
            some = [df.withColumn("places", F.filter("places", lambda p: table(p).between(tables[0], tables[-1]))) if len(rounds) > 1 else df for df in (data, asks)]  # noqa: B023
            floors = so_far.select(F.col("query_id").alias("vec_id"), "floor") if so_far else None
            some[1] = some[1].join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", none)) if floors else some[1].withColumn("floor", none)
            got = found(*some)
            if so_far:
                got = got.unionByName(so_far.drop("floor"))
            if n == len(rounds) - 1:
                return map_arrow(by_query(got), lambda it: _merge_rows(it, k), "query_id bigint, rank int, vec_id bigint, score double")
            before, so_far = so_far, materialize(map_arrow(by_query(got), lambda it: _packed_rows(it, k), f"{_PACKED}, floor double"), "found")
            discard(*[before] if before else ())
            kept.append(so_far)
            release_shuffles(vectors.sparkSession)

    # One table first, so that most of what later ones hold can be passed over where it is scored.
    at_once = max(1, cfg.round_bytes // max(1, sum(counts.values()) * (np.dtype(kind).itemsize * dim + 64)))
    rounds = [range(cfg.tables)] if at_once >= cfg.tables else [range(1), *(range(t, min(cfg.tables, t + at_once)) for t in range(1, cfg.tables, at_once))]
    kept: list[DataFrame] = []
    out = materialize(ranked(data, asks, rounds), "ranked")
    enough = min(k, base.select("vec_id").distinct().limit(k + 1).count() - 1)
    got = out.groupBy("query_id").agg(F.count("*").alias("n"))
    few = queries.join(got, F.col("vec_id") == F.col("query_id"), "left").where(F.coalesce("n", F.lit(0)) < enough).select("vec_id", "vec")
    few = materialize(few, "few")
    if not few.isEmpty():
        zero = F.lit(0).cast("bigint")
        one = ["vec_id", "vec", F.array(F.struct(F.lit(_ALL).cast("bigint").alias("slice"), zero.alias("cell"), F.lit(0.0).alias("level"))).alias("places")]
        rest = materialize(ranked(base.select(*one), few.select(*one), [range(1)]), "rest")
        out = materialize(out.join(few.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest), "ranked")
    discard(base, data, asks, few, *kept)
    return out
