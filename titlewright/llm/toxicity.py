"""Toxicity by a classifier chain: linear models for categories in sequence, each fed the earlier categories' probabilities.

Features are the presence of words and word beginnings that separate the classes in the labelled rows, and a few shares of the
text's characters and words. In training, the earlier categories' probabilities come from models that haven't seen the row
(out-of-fold), as they will in use. The models are fitted on the driver on a bounded sample of labelled rows, of which only the
chosen words come there: words are counted and chosen on the executors.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlewright.llm.arrow import longs, map_arrow
from titlewright.session import discard, materialize


_PUNCT = bytes(32 if i < 48 or 58 <= i <= 64 or 91 <= i <= 96 or 123 <= i <= 127 else i for i in range(256))
_UPPER, _MARKS = bytes(range(65, 91)), bytes(i for i in range(33, 127) if not chr(i).isalnum())
_DENSE = 5


@dataclass(frozen=True)
class Chain:
    """Settings. sample bounds the labelled rows (a third of them at most of the last category's positives, all in expectation);
    features bounds the words and beginnings that speak for a category; least is the likelihood ratio (G squared) of one that counts. sparse
    is the penalty of a weight's absolute value, penalty of its square. Below the out-of-fold F1 of
    trust the threshold is that of the out-of-fold precision sure instead."""

    sample: int = 6000
    features: int = 800
    least: float = 22.0
    folds: int = 3
    sparse: float = 3e-4
    penalty: float = 1e-5
    steps: int = 200
    trust: float = 0.5
    sure: float = 0.9


def _words(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_PUNCT).split()


def _parts(word: bytes) -> list[int]:
    """32-bit hashes of a word and of its beginnings of 4, 5 and 6 characters, each kind with a seed of its own."""
    s = word.decode("utf-8", "replace")
    return [zlib.crc32(word, 99), *(zlib.crc32(s[:n].encode(), n) for n in (4, 5, 6) if len(s) >= n)]


def _dense(text: bytes, n: int, distinct: int) -> list[float]:
    size = max(1, len(text))
    lines = text.count(b"\n") + 1
    return [min(12.0, np.log1p(n)) / 12, distinct / max(1, n), (size - len(text.translate(None, _UPPER))) / size, (size - len(text.translate(None, _MARKS))) / size, min(1.0, 20 * lines / size)]


def _feature_rows(it):
    for batch in it:
        parts, dense = [], []
        for text in batch.column("text").to_pylist():
            w = _words(text or b"")
            once = set(w)
            parts.append(np.array(sorted({h for x in once for h in _parts(x)}), np.uint32).tobytes())
            dense.append(np.array(_dense(text or b"", len(w), len(once))).tobytes())
        rest = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(parts, pa.binary()), pa.array(dense, pa.binary())], [*batch.schema.names[:-1], "parts", "dense"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, part: np.ndarray, cfg: Chain) -> np.ndarray:
    """Weights of a sparse logistic model on the rows in part, by accelerated proximal steps; x's last column is 1. Classes weigh
    alike. Of words that always come together, as in copies of one text, the penalty leaves those that explain the other texts as
    well. All rows are multiplied and those outside part weigh nothing, so that no fold copies the matrix."""
    pos, neg = part & (y == 1), part & (y == 0)
    if not pos.any() or not neg.any():
        w = np.zeros(x.shape[1])
        w[-1] = 30.0 * (int(pos.any()) - int(neg.any()))
        return w
    weight = (pos * (0.5 / pos.sum()) + neg * (0.5 / neg.sum())).astype(np.float32)
    v = np.full(x.shape[1], 1 / np.sqrt(x.shape[1]), np.float32)
    for _ in range(20):  # the largest curvature
        v = x.T @ (weight * (x @ v))
        top = float(np.linalg.norm(v))
        v /= np.float32(top)
    rate = np.float32(1 / (0.25 * 1.1 * top + cfg.penalty))
    shrink = np.full(x.shape[1], rate * cfg.sparse, np.float32)
    shrink[-1] = 0
    w = np.zeros(x.shape[1], np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(cfg.steps):
        g = x.T @ (weight * (_sigmoid(x @ ahead) - y).astype(np.float32)) + np.float32(cfg.penalty) * ahead
        new = ahead - rate * g
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + np.float32((t - 1) / t2) * (new - w)
        w, t = new, t2
    return w.astype(np.float64)


def _ratio(a: Column, df: Column, positives: float, rows: float) -> Column:
    """The likelihood ratio of a feature that is in df rows of which a are positive."""

    def part(seen: Column, expected: Column) -> Column:
        return seen * F.log(F.greatest(seen, F.lit(1e-9)) / F.greatest(expected, F.lit(1e-9)))

    share, rest = positives / rows, F.lit(float(rows)) - df
    return 2 * (part(a, df * share) + part(df - a, df * (1 - share)) + part(positives - a, rest * share) + part(rest - (positives - a), rest * (1 - share)))


def _count_rows(it, n: int):
    """Of each batch's features, in how many rows they are (h, df) and in how many of each category (a0, ...)."""
    for batch in it:
        parts = [np.frombuffer(p.as_buffer(), np.uint32) for p in batch.column("parts")]
        if not parts:
            continue
        h, df = np.unique(np.concatenate(parts), return_counts=True)
        columns = [longs(h), longs(df)]
        for i in range(n):
            hit, many = np.unique(np.concatenate([p for p, y in zip(parts, batch.column(f"y{i}").to_pylist(), strict=True) if y] or [h[:0]]), return_counts=True)
            own = np.zeros(len(h), np.int64)
            own[np.searchsorted(h, hit)] = many
            columns.append(longs(own))
        yield pa.RecordBatch.from_arrays(columns, ["h", "df", *[f"a{i}" for i in range(n)]])


def _hit_rows(it, names: np.ndarray):
    """Of each row's features the numbers of those that were chosen."""
    for batch in it:
        hits = []
        for p in batch.column("parts"):
            own = np.frombuffer(p.as_buffer(), np.uint32)
            hits.append(np.flatnonzero(np.isin(names, own)).astype(np.int32).tobytes())
        rest = [batch.column(c) for c in batch.schema.names if c != "parts"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(hits, pa.binary())], [*(c for c in batch.schema.names if c != "parts"), "hits"])


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap that gives the best F1 on out-of-fold probabilities; 1.1 without positives."""
    if not y.any():
        return 1.1
    order = np.argsort(-p)
    s, hit = p[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    f1[:-1][s[1:] == s[:-1]] = -1
    best = int(np.argmax(f1))
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0.0)) / 2)


def _sure_threshold(p: np.ndarray, y: np.ndarray, sure: float) -> float:
    """The middle of the gap under the most rows of which a share of `sure` is positive out of fold; if no cut has that, the middle
    between the highest probability and 1. 1.1 without positives."""
    if not y.any():
        return 1.1
    order = np.argsort(-p)
    s = p[order]
    good = np.cumsum(y[order]) >= sure * np.arange(1, len(s) + 1)
    good[:-1] &= s[1:] != s[:-1]
    if not good.any():
        return float((s[0] + 1) / 2)
    best = int(np.flatnonzero(good)[-1])
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0.0)) / 2)


@dataclass
class Model:
    categories: tuple[str, ...]
    vocabulary: dict[int, int]
    weights: list[np.ndarray]
    thresholds: list[float]
    accuracy: list[float]  # out-of-fold F1 of each category

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = np.zeros((len(x), len(self.categories)))
        for i, w in enumerate(self.weights):
            p[:, i] = _sigmoid(x @ w[: x.shape[1]] + p[:, :i] @ w[x.shape[1] : -1] + w[-1])
        return p


def fit_chain(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], cfg: Chain | None = None) -> Model:
    """A chain for the 0/1 columns `categories` of labels (doc_id and those), in that order. Rows without a label, an id or a
    document are left out, as are labels other than 0 and 1; rows that repeat an id count once, with the least text and the greatest labels. Null and empty texts have no
    words. Long texts count whole; what comes to the driver is bounded by cfg.sample rows of the chosen features. Without rows, or
    with one class only, a category is that class (or 0.5) for all and nothing is flagged."""
    cfg = cfg or Chain()
    y_of = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)]).dropna()
    y_of = y_of.where(" and ".join(f"y{i} in (0, 1)" for i in range(len(categories))))
    last = f"y{len(categories) - 1}"
    counts = {r[0]: r[1] for r in y_of.groupBy(last).count().collect()}
    rate = {k: min(1.0, share * cfg.sample / max(1, counts.get(k, 0))) for k, share in ((1, 1 / 3), (0, 2 / 3))}
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = y_of.where(draw < F.when(F.col(last) == 1, rate[1]).otherwise(rate[0])).groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))])
    # Bounded by cfg.sample.
    some = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    some = some.groupBy("doc_id", *[f"y{i}" for i in range(len(categories))]).agg(F.min("text").alias("text"))
    names = ["doc_id", *[f"y{i}" for i in range(len(categories))]]
    ys = "".join(f"y{i} int, " for i in range(len(categories)))
    got = materialize(map_arrow(some.select(*names, "text"), _feature_rows, f"doc_id bigint, {ys}parts binary, dense binary"), "features")
    total = got.agg(F.count("*"), *[F.sum(f"y{i}") for i in range(len(categories))]).first()
    if not total[0]:
        discard(got)
        return Model(categories, {}, [np.zeros(_DENSE + i + 1) for i in range(len(categories))], [1.1] * len(categories), [0.0] * len(categories))
    counts = map_arrow(got, lambda it: _count_rows(it, len(categories)), "h bigint, df bigint" + "".join(f", a{i} bigint" for i in range(len(categories))))
    counts = materialize(counts.groupBy("h").agg(F.sum("df").alias("df"), *[F.sum(f"a{i}").alias(f"a{i}") for i in range(len(categories))]).where("df >= 5"), "counts")
    chosen_parts: set[int] = set()
    for i in range(len(categories)):
        sign = counts.where(F.col(f"a{i}") * total[0] > F.col("df") * total[i + 1])  # signs of a category, none against it
        g2 = sign.select("h", _ratio(F.col(f"a{i}"), F.col("df"), float(total[i + 1]), float(total[0])).alias("g2")).where(F.col("g2") >= cfg.least)
        chosen_parts |= {r[0] for r in g2.orderBy(F.desc("g2"), "h").limit(cfg.features).collect()}
    names = np.array(sorted(chosen_parts), np.uint32)
    rows = sorted(map_arrow(got, lambda it: _hit_rows(it, names), f"doc_id bigint, {ys}dense binary, hits binary").collect())
    discard(got, counts)
    ids = [r[0] for r in rows]
    y = np.array([r[1 : 1 + len(categories)] for r in rows], np.float64)
    dense = np.array([np.frombuffer(r["dense"]) for r in rows], np.float32)
    n_words, width = len(names), len(names) + _DENSE
    x = np.zeros((len(ids), width + len(categories) + 1), np.float32)  # words, shares, earlier categories, 1
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["hits"], np.int32)] = 1
    del rows
    x[:, n_words:width] = dense
    x[:, -1] = 1
    fold = np.array([zlib.crc32(str(i).encode()) % cfg.folds for i in ids])
    model = Model(categories, {int(h): i for i, h in enumerate(names)}, [], [], [])
    for i in range(len(categories)):
        out = np.zeros(len(ids))
        for k in range(cfg.folds):
            held = fold == k
            out[held] = _sigmoid(x @ _fit(x, y[:, i], ~held, cfg))[held]
        w = _fit(x, y[:, i], np.ones(len(ids), bool), cfg)
        model.weights.append(np.append(w[: width + i], w[-1]))
        cut = _threshold(out, y[:, i])
        hit = (out >= cut) & (y[:, i] == 1)
        model.accuracy.append(float(2 * hit.sum() / max(1, (out >= cut).sum() + y[:, i].sum())))
        model.thresholds.append(cut if model.accuracy[-1] >= cfg.trust else _sure_threshold(out, y[:, i], cfg.sure))
        x[:, width + i] = out
    return model


def _predict_rows(it, model: Model, width: int, text_at: int):
    known: dict[bytes, tuple[int, ...]] = {}
    find, n_words = model.vocabulary.get, len(model.vocabulary)
    for batch in it:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            x = np.zeros((part.num_rows, n_words + _DENSE))
            for row, text in enumerate(part.column(text_at).cast(pa.binary()).to_pylist()):
                w = _words(text or b"")
                once = set(w)
                for word in once:
                    at = known.get(word)
                    if at is None:
                        if len(known) > 200_000:
                            known.clear()
                        at = known[word] = tuple(i for h in _parts(word) if (i := find(h)) is not None)
                    if at:
                        x[row, list(at)] = 1
                x[row, n_words:] = _dense(text or b"", len(w), len(once))
            p = model.probabilities(x)
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(width)), *(pa.array(p[:, i]) for i in range(p.shape[1]))], [*part.schema.names[:width], *(f"p{i}" for i in range(p.shape[1]))])


def score_chain(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of docs, p_<category> for each category and toxic, which is whether the last category's probability
    reaches its threshold. Whole texts are read, however long; null and empty ones have no words and follow the other features.
    Repeated rows score alike, null ids stay, other columns are ignored, kept ones of the result's names stand beside these, and
    an empty table gives no rows."""
    given = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    kinds = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    at = keep.index("text") if "text" in keep and isinstance(docs.schema["text"].dataType, T.StringType) else len(keep)
    src = docs.select(*given) if at < len(keep) else docs.select(*given, F.col("text").cast("binary").alias("raw"))
    schema = T.StructType([*kinds, *(T.StructField(f"p{i}", T.DoubleType()) for i in range(len(model.categories)))])
    out = map_arrow(src, lambda it: _predict_rows(it, model, len(keep), at), schema)
    toxic = (F.col(f"p{len(model.categories) - 1}") >= F.lit(model.thresholds[-1])).alias("toxic")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"p{i}").alias(f"p_{c}") for i, c in enumerate(model.categories)], toxic)
