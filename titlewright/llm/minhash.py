"""Near-duplicate detection over word shingles: fast similarity sketches, banding and exact verification.

The sketch fills its coordinates in rounds. In each of the first `coords` rounds every shingle is thrown into one
random coordinate with a random value; in each of the next `coords` rounds every shingle goes to the one coordinate that
the round names. A coordinate keeps the least value of the first round that reaches it, so after both halves every
coordinate is filled, whatever the set's size, and estimates concentrate as those of independent draws do. Sets with many
shingles are done after a round or two.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlewright.llm.arrow import groups, lists, longs, map_arrow
from titlewright.llm.components import components
from titlewright.llm.hashing import ASCII_LOWER, U, batches, grams, joined, mix, words
from titlewright.llm.skew import keyed_join
from titlewright.session import discard, materialize

_SHINGLE = 0xA24BAED4963EE407
_NONE = U(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class NearDup:
    """words: of a shingle. percent: least Jaccard similarity of a link. bands * rows: coordinates of a sketch. alike: share of
    coordinates that must agree before two sets of a block are compared. member_rows, minor_rows, block_shingles bound a block.

    With 22 bands of 3 rows a pair at similarity 0.75 shares no band with probability 6e-6, and agrees in fewer than 0.3 of the
    coordinates with probability 1e-14.
    """

    words: int = 5
    percent: int = 75
    bands: int = 22
    rows: int = 3
    alike: float = 0.3
    member_rows: int = 1024
    minor_rows: int = 256
    block_shingles: int = 4 << 20

    @property
    def coords(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of lower-cased texts, all distinct shingle hashes, by text and value, and the number of them for each text."""
    data, begins = joined([t.translate(ASCII_LOWER) if t else None for t in texts])
    starts, _, h = words(data)
    owner = np.searchsorted(begins, starts, "right") - 1
    per = np.bincount(owner, minlength=len(texts))
    g = grams(h, width, _SHINGLE)
    own = owner[: len(g)]
    whole = own == owner[width - 1 :] if len(g) else np.empty(0, bool)
    g, own = g[whole], own[whole]
    if len(short := np.flatnonzero((per > 0) & (per < width))):
        first = np.concatenate(([0], np.cumsum(per)))
        one = np.array([int(grams(h[first[i] : first[i + 1]], per[i], _SHINGLE + 2 * int(per[i]))[0]) for i in short], U)
        g, own = np.concatenate((g, one)), np.concatenate((own, short))
    order = np.lexsort((g, own))
    g, own = g[order], own[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
    return g[new], np.bincount(own[new], minlength=len(texts))


def sketches(g: np.ndarray, sizes: np.ndarray, coords: int) -> np.ndarray:
    """The sketch of each set, a row of `coords` values; rows of empty sets stay unfilled."""
    n = len(sizes)
    out = np.full(n * coords, _NONE, U)
    own = np.repeat(np.arange(n), sizes)
    for k in range(2 * coords):
        if not len(g):
            break
        value = mix(g ^ U((k + 1) * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF))
        bin_ = ((value & U(0xFFFFFFFF)) * U(coords) >> U(32)).astype(np.int64) if k < coords else k - coords
        cell = own * coords + bin_
        free = out[cell] == _NONE
        np.minimum.at(out, cell[free], value[free])
        left = (out.reshape(n, coords) == _NONE).any(1)[own]
        g, own = g[left], own[left]
    return out.reshape(n, coords)


def _sketch_rows(it, cfg: NearDup):
    for batch in it:
        ids, keys, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        for lo, hi in batches(texts):
            g, sizes = shingle_sets(texts[lo:hi], cfg.words)
            s = sketches(g, sizes, cfg.coords)
            ends = np.cumsum(sizes)
            digests = np.array([np.frombuffer(hashlib.blake2b(g[e - n : e].tobytes(), digest_size=16).digest(), np.int64) for e, n in zip(ends, sizes, strict=True)])
            band = np.zeros((hi - lo, cfg.bands), U) + np.arange(1, cfg.bands + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)
            for k in range(cfg.rows):
                band = mix(band + s.reshape(hi - lo, cfg.bands, cfg.rows)[:, :, k])
            short = (mix(s) & U(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), keys.slice(lo, hi - lo), longs(sizes), longs(digests[:, 0]), longs(digests[:, 1]), lists(band), pa.array([r.tobytes() for r in short], pa.binary())],
                ["doc_id", "text_key", "n_shingles", "d1", "d2", "bands", "short"],
            )


def _set_rows(it, cfg: NearDup):
    for batch in it:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in batches(texts):
            g, sizes = shingle_sets(texts[lo:hi], cfg.words)
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array([g[e - n : e].tobytes() for e, n in zip(np.cumsum(sizes), sizes, strict=True)], pa.binary())], ["node", "shingles"])


def _near(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are near enough, counted in whole numbers."""
    if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    at = np.minimum(np.searchsorted(p, q), len(p) - 1)
    both = int(np.count_nonzero(p[at] == q))
    return 100 * both >= percent * (len(p) + len(q) - both)


def _star_links(it, cfg: NearDup):
    """Of rows that are sorted by hub, block and kind, the hub's set before its members': the members that are near enough. Only
    the hub's set is held."""
    key, hub = None, None
    for batch in it:
        a, blk, kind, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("a", "blk", "member", "b"))
        keep = []
        for i, x in enumerate(batch.column("shingles")):
            own = np.frombuffer(x.as_buffer(), U)
            if not kind[i]:
                key, hub = (a[i], blk[i]), own.copy()
            elif key == (a[i], blk[i]) and _near(hub, own, cfg.percent):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([longs(a[keep]), longs(b[keep])], ["a", "b"])


def _near_links(it, cfg: NearDup):
    """Within blocks of a bucket (minor rows against all), links that join different components, one for each joining.

    Pairs whose short sketches agree are compared on their whole sets; only a forest of links leaves the block, never a row for
    each pair.
    """
    for t in groups(it, ["bh", "qb", "db"]):
        minor = t.column("minor").to_numpy(zero_copy_only=False).astype(bool)
        if not minor.any() or minor.all():
            continue
        node, comp, hub = (t.column(k).to_numpy() for k in ("node", "comp", "hub"))
        sk = np.frombuffer(b"".join(t.column("short").to_pylist()), np.uint8).reshape(len(node), -1)
        sets = [np.frombuffer(x.as_buffer(), U) for x in t.column("shingles")]
        size = np.array([len(x) for x in sets])
        every = np.flatnonzero(~minor)
        root = {int(c): int(c) for c in np.unique(comp)}

        def find(c: int, root=root) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        for i in np.flatnonzero(minor):
            like = (sk[every] == sk[i]).mean(1) >= cfg.alike
            like &= (comp[every] != comp[i]) & (node[every] != hub[every]) & (node[i] != hub[i])
            like &= 100 * np.minimum(size[every], size[i]) >= cfg.percent * np.maximum(size[every], size[i])
            near = every[like]
            near = near[[find(int(c)) != find(int(comp[i])) for c in comp[near]]] if len(near) else near
            if not len(near):
                continue
            values = np.concatenate([sets[j] for j in near])
            at = np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)
            both = np.add.reduceat((sets[i][at] == values).astype(np.int64), np.concatenate(([0], np.cumsum(size[near])[:-1])))
            for j in near[100 * both >= cfg.percent * (size[near] + size[i] - both)]:
                x, y = find(int(comp[j])), find(int(comp[i]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((min(node[i], node[j]), max(node[i], node[j])))
        if out:
            a, b = np.array(out, np.int64).T
            yield pa.RecordBatch.from_arrays([longs(a), longs(b)], ["a", "b"])


def _verified_stars(star: DataFrame, sets: DataFrame, cfg: NearDup) -> DataFrame:
    """Of the pairs (a, b), those whose sets are near enough. The members of a hub a are dealt out in blocks, each with its set."""
    hubs = materialize(star.groupBy("a").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / cfg.member_rows)), "hubs")
    dealt = keyed_join(star, hubs, ["a"]).withColumn("blk", F.pmod(F.xxhash64("b"), "blocks"))
    members = dealt.join(sets, dealt["b"] == sets["node"]).select("a", "blk", F.lit(True).alias("member"), "b", "shingles")
    own = hubs.join(sets, hubs["a"] == sets["node"]).select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("blk"), F.lit(False).alias("member"), F.col("a").alias("b"), "shingles")
    rows = own.unionByName(members).repartition("a", "blk").sortWithinPartitions("a", "blk", "member")
    out = materialize(map_arrow(rows, lambda it: _star_links(it, cfg), "a bigint, b bigint"), "links")
    discard(hubs)
    return out


def _block_links(known: DataFrame, short: DataFrame, sets: DataFrame, cfg: NearDup) -> DataFrame:
    """Links between components that meet in a bucket. known: bh, hub, node, size, comp."""
    sizes = known.groupBy("bh", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    mixed = sizes.groupBy("bh").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.max("n").alias("main_n"), F.count("*").alias("comps"))
    # Blocks are bounded in rows and, on average, in shingles.
    many = F.greatest(F.lit(1.0), F.col("size") / F.col("n") * cfg.member_rows / cfg.block_shingles)
    mixed = mixed.where("comps > 1 and n > 2").select("bh", "n", "main", F.ceil((F.col("n") - F.col("main_n")) * many / cfg.minor_rows).alias("nq"), F.ceil(F.col("n") * many / cfg.member_rows).alias("nd"))
    mixed = materialize(mixed, "mixed")
    if mixed.isEmpty():
        discard(mixed)
        return known.sparkSession.createDataFrame([], "a bigint, b bigint")
    odd = keyed_join(known, mixed, ["bh"]).join(short, "node").join(sets, "node")
    spread, zero = F.xxhash64("node"), F.lit(0).cast("bigint")
    columns = ["bh", "hub", "node", "comp", "short", "shingles"]
    every = odd.select(*columns, F.lit(False).alias("minor"), F.explode(F.sequence(zero, F.col("nq") - 1)).alias("qb"), F.pmod(spread, "nd").alias("db"))
    minor = odd.where("comp <> main").select(*columns, F.lit(True).alias("minor"), F.pmod(spread, "nq").alias("qb"), F.explode(F.sequence(zero, F.col("nd") - 1)).alias("db"))
    blocks = every.unionByName(minor).repartition("bh", "qb", "db").sortWithinPartitions("bh", "qb", "db")
    out = materialize(map_arrow(blocks, lambda it: _near_links(it, cfg), "a bigint, b bigint").distinct(), "pairs")
    discard(mixed)
    return out


def near_duplicates(docs: DataFrame, cfg: NearDup | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key (a hash of the text) and group_key for every row of docs. group_key tells
    components apart even where ids repeat; it is null for a row without shingles or id.

    Documents of equal shingle sets first become one class with its least id. Classes that share a band are candidates.
    In each bucket all members are verified against the bucket's least member, on their whole sets. What these links
    don't yet join is then compared exhaustively within its bucket, in blocks of bounded size: rows outside the bucket's main
    component against all rows of other components, on whole sets of 64-bit hashes, but for pairs whose sketches agree in under
    0.3 of the coordinates (9 standard deviations under the threshold). No bucket is capped.

    Null or empty texts, and texts of white space only, have no shingles: component_id is their own id and they are kept.
    Repeated rows are one class. Rows that share an id but differ in text are documents of their own: each has the least id of
    its own component. Rows with a null id are linked with nothing, have a null component_id and are kept. Very long texts are
    read whole, in segments. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    cfg = cfg or NearDup()
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col).cast("binary")).alias("text_key"), F.col(text_col).cast("binary").alias("text"))
    rows = materialize(map_arrow(src, lambda it: _sketch_rows(it, cfg), "doc_id bigint, text_key bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, short binary"), "sketches")
    live = rows.where("n_shingles > 0 and doc_id is not null")
    best = F.min_by(F.struct("text_key", "n_shingles", "bands", "short"), F.struct("doc_id", "text_key"))
    classes = live.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), best.alias("of"))
    classes = materialize(classes.select("d1", "d2", "n", "rep", "of.*"), "classes")
    # Where an id has several texts, a class can't go by its least id: it goes by half of its digest then.
    twice = not classes.groupBy("rep").count().where("count > 1").isEmpty()
    node = F.col("d1" if twice else "rep").alias("node")

    band = classes.select(node, F.col("n_shingles").alias("size"), F.explode("bands").alias("bh"))
    hubs = band.groupBy("bh").agg(F.min("node").alias("hub"), F.max("node").alias("most"), F.count("*").alias("n"))
    hubs = materialize(hubs.where("hub < most").select("bh", "hub", "n"), "hubs")
    shared = materialize(keyed_join(band, hubs, ["bh"]).select("bh", "hub", "node", "size"), "buckets")
    wanted = classes.select(node, F.col("rep").alias("doc_id"), "text_key").join(shared.select("node").distinct(), "node")
    texts = src.where("doc_id is not null").join(wanted, ["doc_id", "text_key"]).dropDuplicates(["node"]).select("node", "text")
    sets = materialize(map_arrow(texts, lambda it: _set_rows(it, cfg), "node bigint, shingles binary"), "sets")
    star = materialize(shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "star")
    links = _verified_stars(star, sets, cfg)
    comps = components(links)

    known = shared.join(comps, "node", "left").select("bh", "hub", "node", "size", F.coalesce("component", "node").alias("comp")).distinct()
    known = materialize(known, "known")
    more = _block_links(known, classes.select(node, "short").dropDuplicates(["node"]), sets, cfg)
    if not more.isEmpty():
        comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    discard(hubs, shared, sets, star, links, known, more)

    of = classes.select("d1", "d2", "n", "rep", node).join(comps, "node", "left").withColumn("group_key", F.coalesce("component", "node"))
    if twice:
        of = of.join(of.groupBy("group_key").agg(F.min("rep").alias("component_id")), "group_key")
    else:
        of = of.withColumn("component_id", F.col("group_key"))
    of = materialize(of.where("n > 1 or component_id <> rep or group_key <> node").select("d1", "d2", "n", "component_id", "group_key"), "of")
    flat = rows.select("doc_id", "text_key", "n_shingles", "d1", "d2")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    linked = keyed_join(flat.where(~alone), of, ["d1", "d2"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn("group_key", F.coalesce("group_key", "d1" if twice else "doc_id"))
    out = linked.unionByName(flat.where(alone).withColumn("component_id", F.col("doc_id")).withColumn("group_key", F.lit(None).cast("bigint")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"), "text_key", "group_key")
