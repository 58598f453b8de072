"""Each operator against a brute-force version or an exact round trip, with nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns of clashing names."""

import gzip
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def vocabulary(n=400, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(2, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    """doc_id, text and columns that clash with those of the operators."""
    rng, v = random.Random(5), vocabulary()
    para = lambda n: " ".join(rng.choice(v) for _ in range(n))
    passage, line = para(55), "  " + para(12) + "\t"
    texts = ["", None, " \n\t", "one", "a b c", "a b  c", para(4), "<|endoftext|> x<|endoftext|>", "\x00 ퟿", para(30_000), "x" * 50_000]
    texts += [para(rng.randint(5, 300)) for _ in range(60)]
    base = para(200).split()
    for k in range(40):  # near copies, of which some are linked through others only
        w = list(base)
        for j in range(k):
            w[j * 5 % 200] = f"new{j}"
        texts.append(" ".join(w))
    texts += [para(40) + "\n" + passage + "\n" + line + "\n" + para(20) for _ in range(12)] + [line.upper().replace("SS", "ß")] * 3
    texts += [texts[20]] * 6 + [texts[21].upper()] + [passage + " " + passage]
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 7 else None, len(t or ""), i, "q", 1, 2) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, chunk bigint, key string, pos int, size int"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.fixture(scope="module")
def rows(corpus):
    return sorted((r["doc_id"], r["text"]) for r in corpus.collect())


def empty(df):
    return df.limit(0)


# --- 3


def brute_substrings(rows, width=20):
    seen, out = set(), {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            s = tuple(w[k : k + width])
            if s in seen:
                gone[k : k + width] = [True] * width
            seen.add(s)
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_substrings(corpus, rows, batches):
    from titlewright.llm.substrings import substring_dedup

    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(corpus, batches, digest=True).collect()}
    assert got == brute_substrings(rows) and sum(x[1] for x in got.values()) > 500


def test_substrings_edges(spark, corpus):
    from titlewright.llm.substrings import substring_dedup

    assert substring_dedup(empty(corpus)).collect() == []
    long = " ".join(map(str, range(30)))
    got = substring_dedup(spark.createDataFrame([(None, long), (1, long), (1, long), (2, None)], "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got if r["doc_id"] is None or r["doc_id"] < 2)[0] == (False, None, 30, 0, long)
    assert sum(r["n_removed"] for r in got) == 60 and len(got) == 4


def test_index_grows_and_compacts(spark, tmp_path):
    from titlewright.llm.substrings import Index, add_batch

    index, texts = Index(f"file://{tmp_path}/index", fan_in=2), [" ".join(f"{k}-{j}" for j in range(40)) for k in range(5)]
    levels = []
    for n, t in enumerate(texts):
        path = add_batch(spark.createDataFrame([(2 * n, t), (2 * n + 1, texts[0])], "doc_id bigint, text string"), index)
        got = {r["doc_id"]: r["n_removed"] for r in spark.read.parquet(path).collect()}
        assert got == {2 * n: 0, 2 * n + 1: 40}
        levels.append([r.level for r in index.runs])
        index = Index.load(spark, index.path)  # as another session would
    assert levels == [[0], [0, 0], [1, 0], [1, 0, 0], [2, 0]] and len(index.archives) == 5 and index.version == 8
    assert spark.read.parquet(add_batch(spark.createDataFrame([], "doc_id bigint, text string"), index)).collect() == [] and index.version == 8
    with pytest.raises(ValueError, match="must follow"):
        add_batch(spark.createDataFrame([(9, "x")], "doc_id bigint, text string"), index)
    stale = Index.load(spark, index.path)
    index.save(spark)
    with pytest.raises(Exception, match="exist"):  # two sessions can't both add
        stale.save(spark)


def test_index_over_sessions_equals_one_batch(spark, corpus, rows, tmp_path):
    from titlewright.llm.substrings import Index, add_batch

    Index(f"file://{tmp_path}/index", fan_in=2).save(spark)
    got = {}
    for n, (lo, hi) in enumerate([(0, 30), (30, 60), (60, 61), (61, 100), (100, 1000)]):
        index = Index.load(spark, f"file://{tmp_path}/index")
        path = add_batch(corpus.where(f"doc_id >= {lo} and doc_id < {hi}"), index, True, chunk_bytes=3000, buckets=[2, 8, 1, 4, 8][n])
        got |= {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in spark.read.parquet(path).collect()}
    assert got == brute_substrings(rows)


@pytest.mark.parametrize("batches", [1, 3])
def test_collisions_remove_no_words(spark, monkeypatch, batches):
    """Every window has one of a few fingerprints: what goes are repeats only, and a repeat of the first of them goes."""
    from titlewright.llm import substrings as m
    from titlewright.llm.hashing import U

    def worthless(h, window, anchor):
        n = max(0, len(h) - window + 1)
        return np.full(n, 1 << 40, U), h[:n] % U(2)

    monkeypatch.setattr(m, "fingerprints", worthless)
    text = [" ".join(f"{k}-{j}" for j in range(30)) for k in range(4)]
    texts = [text[0], text[1], text[0], text[2], text[1] + " " + text[3], text[3] + "\n" + text[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["kept"].split() for r in m.substring_dedup(df, batches).collect()}
    want = brute_substrings(list(enumerate(texts)))
    for i, t in enumerate(texts):
        assert len(got[i]) >= want[i][0] - want[i][1] and set(got[i]) <= set(t.split())
    assert all(got[i] == texts[i].split() for i in (0, 1, 3)) and len(got[2]) < 30 and (batches > 1 or got[2] == [])


def test_streamed_merge():
    from titlewright.llm.hashing import U
    from titlewright.llm.substrings import _key, _order, _streamed_merge

    rng = np.random.default_rng(3)
    a, c = rng.integers(0, 1 << 30, 4000).astype(U) << U(28), rng.integers(0, 1 << 48, 4000).astype(U)
    a[:900], c[:900] = a[0], np.arange(900, dtype=U)  # many share a key
    of, streams = rng.integers(0, 3, 4000), []
    for k in range(4):  # the last one is empty
        x, y, z = a[of == k], c[of == k], np.flatnonzero(of == k)
        order, _ = _order(x, y)
        streams.append(iter([(x[order[i : i + 100]], y[order[i : i + 100]], z[order[i : i + 100]]) for i in range(0, len(order), 100)]))
    got = list(_streamed_merge(streams))
    x, y, z = (np.concatenate(t) for t in zip(*got))
    order, new = _order(a, c)
    assert new.all() and (x == a[order]).all() and (y == c[order]).all() and sorted(z.tolist()) == list(range(4000)) and len(got) > 10 and (np.diff(_key(x, y).astype(np.float64)) >= 0).all()


def test_pack():
    from titlewright.llm.hashing import U
    from titlewright.llm.substrings import _lookup, _order, pack, unpack

    a = np.sort(np.repeat(np.random.default_rng(1).integers(0, 1 << 62, 50).astype(U), 17))
    a[:700] = a[0]
    c = np.random.default_rng(2).integers(0, 1 << 48, len(a)).astype(U)
    order, _ = _order(a, c)
    a, c = a[order], c[order]
    for ids in (np.arange(len(a)) // 300, np.where(np.arange(len(a)) < 300, -(1 << 63), (1 << 63) - 1), np.arange(len(a)) - (1 << 40)):
        x, y, z = unpack(pack(a, c, ids))
        assert (x == a).all() and (y == c).all() and (z == ids).all()
    assert all(len(x) == 0 for x in unpack(pack(a[:0], c[:0], np.empty(0, np.int64))))
    assert (_lookup((a, c), a[::-1], c[::-1]) == np.arange(len(a))[::-1]).all() and (_lookup((a, c), a, c + U(1)) < 0).mean() > 0.99


def test_hash_equals_sparks(spark):
    from titlewright.llm.hashing import spark_xxhash64

    x = [0, 1, -1, 1 << 62, -(1 << 63), 123456789]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x bigint").orderBy("i").select(F.xxhash64("x")).collect()]
    assert spark_xxhash64(np.array(x, np.int64)).tolist() == got


def test_word_hashes_depend_on_words_only():
    from titlewright.llm.hashing import words as hashed

    text = (" ".join(vocabulary()) + "\n") * 900
    data = text.encode()
    starts, ends, h = hashed(data)
    assert [data[s:e] for s, e in zip(starts, ends)] == data.split() and len(data) > 3 << 20
    by = defaultdict(set)
    for w, x in zip(data.split(), h.tolist()):
        by[w].add(x)
    assert all(len(s) == 1 for s in by.values()) and len({x for s in by.values() for x in s}) == len(by)


# --- 4


def line_key(line):
    return line.strip(SPACE).translate(LOWER)


def brute_lines(rows):
    docs = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= 40:
                docs[line_key(x)].add(i)
    out = {}
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if len(docs.get(line_key(x), ())) < 5 or i == max(docs[line_key(x)])]
        out[i] = (len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 8, 60])
def test_lines(spark, corpus, rows, parts):
    from titlewright.llm.lines import line_dedup
    from titlewright.session import settings

    with settings(spark, spark__sql__shuffle__partitions=str(parts), spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in line_dedup(corpus, digest=True).collect()}
    assert got == brute_lines(rows) and sum(x[1] for x in got.values()) > 10


def test_lines_edges(spark, corpus):
    from titlewright.llm.lines import line_dedup

    assert line_dedup(empty(corpus)).collect() == []
    x = "y" * 40
    df = spark.createDataFrame([(i // 2, f"{x}\n{x}", i) for i in range(10)] + [(None, x, 0), (None, None, 0)], "doc_id bigint, text string, kept int")
    got = line_dedup(df, carry=("kept",))
    assert got.columns == ["doc_id", "kept", "n_lines", "n_dropped", "kept"]
    by = Counter((r[0], r[3]) for r in got.collect())
    assert by == {(0, 2): 2, (1, 2): 2, (2, 2): 2, (3, 2): 2, (4, 0): 2, (None, 0): 2}


def test_lines_strip_white_space_only(spark):
    from titlewright.llm.lines import line_dedup

    stem = "or " + "z" * 36
    texts = [f"{c}{stem}{c}{stem[:1]}" for c in "fF"] * 2 + [f"\x0cf{stem}fo", f"fzf{stem}", "fzf" + stem + "\x0c\x0b", f"\x0c fzf{stem} \x0c"] + [f"\r{x}{stem}" for x in ("FZF", "zf", "fz", "z")]
    texts += ["f" + "y" * 39, "y" * 39 + "F"] * 5 + ["y" * 39, "\x0c" + "y" * 39 + "\x0c"] * 3 + ["w" * 40 + x for x in ("", "f", "F", "\x0c", "\x0cf")]
    rows = list(enumerate(texts))
    want = brute_lines(rows)
    assert sum(x[1] for x in want.values()) > 10
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), digest=True).collect()}
    assert got == want


# --- 8


def shingles(text, n=5):
    w = [x.translate(LOWER) for x in words(text)]
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_near(rows):
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicates(corpus, rows):
    from titlewright.llm.minhash import near_duplicates

    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(corpus).collect()}
    assert got == brute_near(rows)


def test_near_duplicates_edges(spark, corpus):
    from titlewright.llm.minhash import near_duplicates

    assert near_duplicates(empty(corpus)).collect() == []
    got = near_duplicates(spark.createDataFrame([(3, "a b"), (2, "A  B"), (2, "A  B"), (None, "a b"), (4, None)], "doc_id bigint, text string"))
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in got.collect()) == [(0, None, True), (2, 2, True), (2, 2, True), (3, 2, False), (4, 4, True)]


def test_texts_that_share_an_id(spark):
    from titlewright.llm.minhash import near_duplicates

    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (7, b + " more"), (9, a), (5, b), (2, c), (3, c + " end"), (-4, ""), (-4, "x")]
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id bigint, text string, node string, text_key int")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect())
    assert got == {(5, 26, 5, True): 3, (7, 27, 5, False): 1, (9, 26, 5, False): 1, (2, 26, 2, True): 1, (3, 27, 2, False): 1, (-4, 0, -4, True): 1, (-4, 1, -4, True): 1}
    nothing = near_duplicates(spark.createDataFrame([(i, ["", None, " "][i % 3]) for i in range(300)], "doc_id bigint, text string")).collect()
    assert len(nothing) == 300 and all(r["kept"] and r["component_id"] == r["doc_id"] for r in nothing)


def test_blocks_compare_whole_hashes():
    import pyarrow as pa

    from titlewright.llm.hashing import U
    from titlewright.llm.minhash import NearDup, _near_links

    whole = np.sort(np.random.default_rng(6).integers(0, 1 << 62, 100).astype(U))
    # 75 of 100 shared, two of them equal in their lower half; and one that agrees in the lower halves alone.
    whole[1] = (whole[0] & U(0xFFFFFFFF)) | U(1 << 62)
    whole.sort()
    part, false = np.delete(whole, np.flatnonzero((whole & U(0xFFFFFFFF)) != (whole[-1] & U(0xFFFFFFFF)))[:25]), np.sort(whole ^ U(1 << 63))
    assert len(part) == 75 and len(np.unique(whole.astype(np.uint32))) == 99
    sets = [whole, whole, false, part]
    rows = pa.RecordBatch.from_pydict({"bh": [1] * 4, "qb": [0] * 4, "db": [0] * 4, "hub": [0] * 4, "node": [1, 1, 2, 3], "comp": [1, 1, 2, 3], "minor": [True, False, False, False], "short": pa.array([b"abcd"] * 4, pa.binary()), "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})
    assert [r for b in _near_links([rows], NearDup()) for r in b.to_pylist()] == [{"a": 1, "b": 3}]


def test_keyed_join(spark, monkeypatch):
    from titlewright.llm import skew

    monkeypatch.setattr(skew, "PARTS", 4)
    left = spark.createDataFrame([(0, i) for i in range(40)] + [(k, k) for k in range(1, 30)], "k bigint, v bigint")
    right = left.where("k < 20").groupBy("k").agg(F.count("*").alias("n")).withColumn("w", F.col("k") * 2)
    for how, want in (("inner", 59), ("left", 69)):
        got = skew.keyed_join(left, right, ["k"], how).collect()
        assert len(got) == want and all(r["w"] == (2 * r["k"] if r["k"] < 20 else None) for r in got)
    assert skew.keyed_join(left, right.limit(0), ["k"]).collect() == [] and skew.keyed_join(left.limit(0), right, ["k"]).collect() == []


def test_sketches_fill_and_estimate():
    from titlewright.llm.hashing import U
    from titlewright.llm.minhash import sketches

    rng = np.random.default_rng(4)
    tiny = sketches(rng.integers(0, 1 << 62, 3).astype(U), np.array([1, 0, 2]), 66)
    assert (tiny[[0, 2]] != U(0xFFFFFFFFFFFFFFFF)).all() and (tiny[1] == U(0xFFFFFFFFFFFFFFFF)).all()
    same, own = rng.integers(0, 1 << 62, 600).astype(U), [rng.integers(0, 1 << 62, 200).astype(U) for _ in range(2)]
    x, y = sketches(np.concatenate((same, own[0], same, own[1])), np.array([800, 800]), 4000)
    assert abs((x == y).mean() - 0.6) < 0.04


def test_components_of_chains(spark):
    from titlewright.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 99), (7, 7)], "a bigint, b bigint")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 1 for i in range(1, 61)} | {99: 99, 100: 99}
    assert components(edges.limit(0)).collect() == []


# --- 10


def test_bpe(spark, corpus, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    from titlewright.llm.bpe import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    more = ["  two", "trailing ", "don't we'LL", "　wide　", "a\r\n b", "é" * 400, "\x1c \x85 x", "ⅳ½٣", "\U0001f600‍\U0001f600" * 30, "<|endoftext", " <|endoftext|> "]
    df = corpus.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id bigint, text string"))
    ref = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in bpe(df, path, lexicon_words=50).collect()}
    for i, t in [*rows, *((1000 + k, t) for k, t in enumerate(more))]:
        ids = ref.encode(t or "", add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids"]) == (len(ids), ids), repr(t)[:60]
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe(empty(corpus), path).collect() == []


def test_transducer(tmp_path):
    from titlewright.llm.transducer import Transducer, compile_words, packed

    entries = {w.encode(): packed([i, i * 7]) for i, w in enumerate({*vocabulary(), "", "a", "ab", "abc", "xbc"})}
    block = compile_words(entries)
    path = tmp_path / "lexicon"
    path.write_bytes(block)
    with open(path, "rb") as f:
        for t in (Transducer(block), Transducer(f)):
            assert all(t.get(w) == ids for w, ids in entries.items())
            assert t.get(b"abcd") is None and t.get(b"zzz") is None
    # Shared endings: words of one suffix add no state but their own beginnings.
    assert Transducer(compile_words({f"{c}ending".encode(): packed([1]) for c in "abcdefgh"})).states == 8


def test_frequent_words_count_everything(spark):
    from titlewright.llm.bpe import frequent_words

    df = spark.createDataFrame([(i, "x " + "b a " * i + "c") for i in range(5)], "doc_id bigint, text string").repartition(4)
    assert frequent_words(df, 2) == [b"a", b"b"] and frequent_words(df, 1) == [] and frequent_words(df, 9) == [b"a", b"b", b"c", b"x"]


# --- 9


def test_transport(spark, corpus, rows):
    from titlewright.llm.transport import PACKET, padded, read_transport, store_transport

    stored = store_transport(corpus)
    got = {r["doc_id"]: r for r in read_transport(stored).collect()}
    digests = {r["doc_id"]: r for r in read_transport(stored, digest=True).collect()}
    media = {r["doc_id"]: r["media"] for r in stored.collect()}
    for i, t in rows:
        raw = (t or "").encode()
        assert got[i]["payload"] == padded(raw) and got[i]["n_bytes"] == len(raw) and len(padded(raw)) % 192 == 0 and padded(raw).rstrip(b" ") == raw.rstrip(b" ")
        assert digests[i]["payload_sha256"] == hashlib.sha256(padded(raw)).hexdigest() and digests[i]["tail_crc32"] == zlib.crc32(padded(raw)[-16:])
        assert digests[i]["media_bytes"] == len(media[i]) and len(media[i]) % PACKET == 0
        assert got[i]["times"] == [k * 12 * 2160 for k in range(len(got[i]["times"]))] and got[i]["points"][0]["pts"] == 0
    assert read_transport(store_transport(empty(corpus))).collect() == []
    foreign = spark.createDataFrame([(1, None, "x", 0), (2, b"", "y", 0), (3, b"no stream", "z", 0)], "doc_id bigint, media binary, payload_bytes string, points int")
    for digest in (False, True):
        back = read_transport(foreign, digest)
        assert len(set(back.columns)) == len(back.columns) and [r["payload_bytes"] for r in back.collect()] == [0, 0, 0]
    assert [r["payload"] for r in read_transport(foreign).collect()] == [b"", b"", b""]


@pytest.mark.parametrize("frames", [1, 2, 11, 12, 13, 24, 49, 500])
def test_every_stuffing_comes_back(frames):
    from titlewright.llm.transport import DATA_PID, demux, mux

    payload = random.Random(frames).randbytes(192 * frames)
    s = demux(mux(payload))[DATA_PID]
    assert b"".join(s.data) == payload and not s.lost and not s.broken and s.kind == 6 and s.program == 1


def test_damaged_streams():
    from titlewright.llm.transport import DATA_PID, PACKET, crc32_mpeg, demux, mux

    assert crc32_mpeg(b"123456789") == 0x0376E6E7
    payload = random.Random(1).randbytes(192 * 60)
    ts = mux(payload)
    packets = [ts[i : i + PACKET] for i in range(0, len(ts), PACKET)]
    data = [i for i, p in enumerate(packets) if (p[1] << 8 | p[2]) & 0x1FFF == DATA_PID]
    twice = b"".join(p + (p if i == data[5] else b"") for i, p in enumerate(packets))
    assert b"".join(demux(twice)[DATA_PID].data) == payload
    lost = demux(b"".join(p for i, p in enumerate(packets) if i != data[5]))[DATA_PID]
    assert lost.lost == 1 and lost.broken == 1 and len(lost.data) == 4
    noisy = demux(b"noise\x47noise" + ts)[DATA_PID]
    assert b"".join(noisy.data) == payload


def test_times_beyond_33_bits():
    from titlewright.llm import transport

    s = transport.Stream(1, 6, 1)
    for pts in (2**33 - 5, 3):
        body = b"\0\0\1\xbd" + (9).to_bytes(2, "big") + b"\x84\x80\x05" + transport._stamp(pts) + b"x"
        transport._close(s, transport._Open(body, True, 0))
    assert s.times == [2**33 - 5, 2**33 + 3]


# --- 2


def test_warc(spark, tmp_path):
    from titlewright.llm.warc import MAGIC, read_warc, write_warc

    big = "<p>" + "é" * 700
    rows = [(i, f"http://x/{i}", f"page {i} " * (i + 1)) for i in range(150)]
    rows += [(500 + i, "u\r\nWARC-Type: evil", big) for i in range(20)] + [(519, "again", big), (None, None, big), (600, "s", "short"), (601, "s", "short"), (700, "n", None), (701, "n", ""), (702, "m", "WARC/1.1\r\n\r\n" * 200)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, size int").repartition(3)
    path = "file://" + str(tmp_path / "warc")
    write_warc(pages, path)
    html = {i: (h or "").encode() for i, _, h in rows}
    for size in (4 << 20, 3000, 97):
        got = read_warc(spark, path, size).collect()
        assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
        for r in got:
            raw = html[r["page_id"]]
            revisit = raw == big.encode() and r["page_id"] != 519
            assert (r["payload_bytes"], r["declared_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
            assert (r["record_type"], r["refers_to"], r["payload"]) == (("revisit", 519, None) if revisit else ("response", None, raw))
    files = sorted((tmp_path / "warc").glob("part-*"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)
    # A damaged member is passed over.
    data = bytearray(files[0].read_bytes())
    at = data.find(MAGIC, 500)
    data[at + 12] ^= 0xFF
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.txt").write_bytes(data)
    n = read_warc(spark, f"file://{tmp_path}/bad", 5000).count()
    whole_n = gzip.decompress(files[0].read_bytes()).count(b"WARC/1.1\r\nWARC-Type: ")
    assert whole_n - 2 <= n < whole_n or n == whole_n
    write_warc(pages.limit(0), f"file://{tmp_path}/none")
    assert read_warc(spark, f"file://{tmp_path}/none").collect() == []


def test_one_hot_payload_beside_many(spark, monkeypatch):
    from titlewright.llm import warc

    rows = [(i, f"u{i}", "hot " * 300 if i % 3 == 0 else f"{i // 6} " * 600, "x") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, strong string")
    last = {}
    for i, _, h, _ in rows:
        last[h] = i
    for few in (1000, 3):  # broadcast, and split by how often payloads come
        monkeypatch.setattr(warc, "_FEW", few)
        got = {r["page_id"]: r for r in warc.roles(pages).collect()}
        assert len(got) == 300 and all(got[i]["refers_to"] == (None if last[h] == i else last[h]) and got[i]["digest"] == hashlib.sha1(h.encode()).hexdigest() for i, _, h, _ in rows)


def test_any_bytes_pass_the_text_writer(spark, tmp_path):
    raw = [bytes(range(256)) * 40, b"\xff\xfe\x80" * 1000, random.Random(3).randbytes(50_000), b""]
    df = spark.createDataFrame([(x,) for x in raw], "members binary").coalesce(1)
    df.select(F.col("members").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", "\x1f\x8b").text(str(tmp_path / "t"))
    whole = b"".join(f.read_bytes() for f in sorted((tmp_path / "t").glob("part-*")))
    assert sorted(whole.split(b"\x1f\x8b")[:-1]) == sorted(raw) or whole == b"".join(x + b"\x1f\x8b" for x in raw)


def test_false_magic_inside_a_member(tmp_path):
    from titlewright.llm.warc import MAGIC, _member, _record, _Window
    from pyarrow import fs

    squeeze = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored as it is: the payload's magic bytes show
    record = _record(1, "u", MAGIC * 50 + b"WARC/", "d", None, "now")
    (tmp_path / "f").write_bytes(squeeze.compress(record) + squeeze.flush())
    system = fs.LocalFileSystem()
    with system.open_input_file(str(tmp_path / "f")) as f:
        w = _Window(f)
        places, at = [], 0
        while (at := w.find(MAGIC, at, f.size())) >= 0:
            places.append(at)
            at += 1
        good = [p for p in places if _member(w, p)]
    assert len(places) == 51 and good == [0]


# --- 7


def test_neighbours(spark):
    from titlewright.llm.neighbours import nearest

    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 24)) * rng.uniform(0.2, 3, (1500, 1))
    x[1001:1040] = x[1000]
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(x)]
    rows += [(5000, None, 0), (5020, [0.0] * 24, 0), (5040, [1.0, None] * 12, 0), (5060, [float("nan")] * 24, 0), (5080, [1.0] * 23, 0), (None, [1.0] * 24, 0), (7, rows[7][1], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, bucket int").repartition(4)
    got = defaultdict(list)
    for r in nearest(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 1500, 20):
        s = (x * x[q]).sum(1)
        want = sorted((i for i in range(1500) if i != q), key=lambda i: (-s[i], i))[:20]
        assert [r[0] for r in got[q]] == list(range(1, 21)) and all(abs(c - s[i]) < 1e-12 for _, i, c in got[q])
        order = [(-c, i) for _, i, c in got[q]]
        assert order == sorted(order)
        hits += len(set(want) & {r[1] for r in got[q]})
    assert set(got) == set(range(0, 1500, 20)) and hits / (20 * len(got)) >= 0.9
    assert nearest(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.5, 0.5])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in nearest(few).orderBy("query_id", "rank").collect()] == [(0, 1, 3, 0.5), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]


@pytest.mark.parametrize("kind", ["one long", "lognormal", "many axes"])
def test_neighbours_of_any_length(spark, kind):
    from titlewright.llm.neighbours import nearest

    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 200 if kind == "many axes" else 64))
    x /= np.sqrt((x * x).sum(1))[:, None]
    if kind == "one long":
        x[77] *= 10
    if kind == "lognormal":
        x *= np.exp(rng.normal(size=(len(x), 1)))
    got = defaultdict(set)
    for r in nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        assert len(got[q]) == 20
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / 3000 >= 0.97


def test_neighbours_that_no_bucket_has(spark):
    from titlewright.llm.neighbours import nearest

    rng = np.random.default_rng(10)
    x = rng.normal(size=(700, 32)) * 0.001 + np.eye(32)[0]
    x[:3] *= -1
    rows = [(i + 1, v.tolist()) for i, v in enumerate(x)] + [(0, (-x[5]).tolist())] + [(900, x[9].tolist())] * 50
    got = defaultdict(list)
    for r in nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    vecs = dict(rows)
    assert set(got) == {i for i in vecs if i % 20 == 0} and all(len(set(ids)) == 20 for ids in got.values())
    s = {i: float((np.array(v) * vecs[0]).sum()) for i, v in rows if i}
    assert got[0] == sorted(s, key=lambda i: (-s[i], i))[:20]



def test_neighbours_probe_in_bounded_rows(spark):
    """What a query carries doesn't grow with the cells that it visits, and rounds of tables find what all tables at once do."""
    import pyarrow as pa

    from titlewright.llm.neighbours import Tables, _band, _probe_rows, nearest

    rng = np.random.default_rng(12)
    x = rng.normal(size=(128, 64)).astype("<f4")
    batch = pa.RecordBatch.from_arrays([pa.array(range(128), pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())], ["vec_id", "vec"])
    cfg = Tables(tables=2)
    out = next(_probe_rows(iter([batch]), cfg, 64, [_band(0, 1_000_000, 64, cfg)], False, "<f4", 0.1))
    assert out.num_rows == 128 and out.nbytes < 4_000_000  # 2 x 200,000 cells a query as a list
    x = rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    once, rounds, sliced = (sorted(map(tuple, nearest(df, cfg=c).collect())) for c in (Tables(), Tables(round_bytes=3 * 3000 * 192), Tables(slice_rows=100, query_block=50)))
    assert once == rounds == sliced and len(once) == 3000


def test_neighbours_of_extreme_lengths(spark):
    from titlewright.llm.neighbours import nearest

    rng = np.random.default_rng(11)
    x = {i: (v * 10.0 ** rng.integers(-3, 3)).tolist() for i, v in enumerate(rng.normal(size=(60, 4)), 100)}
    x |= {0: [1e200, 1.0, 0.0, 0.0], 20: [1e-200, 0.0, 0.0, 0.0], 40: [-1e308, 1e308, 0.0, 0.0], 1: [5e-324, 0.0, 0.0, 0.0], 2: [1e308, 1e308, 0.0, 0.0]}
    df = spark.createDataFrame([(i, v, 1, "c", 0.5) for i, v in x.items()], "vec_id bigint, embedding array<double>, slice int, cells string, score double")
    got = defaultdict(list)
    for r in nearest(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    with np.errstate(all="ignore"):
        for q in (i for i in x if i % 20 == 0):
            s = {i: float((np.array(v) * np.array(x[q])).sum()) for i, v in x.items() if i != q}
            assert got[q] == sorted(s, key=lambda i: (-np.inf if np.isnan(s[i]) else s[i], -i), reverse=True)[:20]


@pytest.mark.parametrize("axes", [(8,), (8, 4), (8, 8, 1), (8, 8, 8, 2)])
def test_visited_cells_are_the_nearest(axes):
    from titlewright.llm.neighbours import Band, Tables, _cells, _rank_shares, _visited, turned

    cfg, rng = Tables(tables=2), np.random.default_rng(len(axes))
    x, band = rng.normal(size=(5, 5)), Band(0, axes, 1)
    for t in turned(x, axes, cfg):
        for i in range(5):
            total = np.zeros(1)
            for y in t:
                total = (total[:, None] + y[i][None, :]).reshape(-1)
            for n in (1, 40, 10**6):
                cells = _visited(t, i, n)
                n = min(n, len(total))
                assert set(np.argsort(-total)[:n].tolist()) <= set(cells.tolist()) and (np.diff(cells) > 0).all()
                assert (total[cells] >= np.sort(total)[-n] - np.ptp(total) / 200).all()
    assert (_rank_shares(x, np.arange(5), x, band, cfg) <= 2 / band.cells).all() and (_cells(x, band, cfg) < band.cells).all()


def test_hadamard():
    from titlewright.llm.neighbours import hadamard

    h = hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)


# --- 6


def test_sharding(spark, corpus, rows, tmp_path):
    from titlewright.llm.sharding import assign_shards, write_shards

    df = corpus.unionByName(spark.createDataFrame([(10_000 + i, "copy " * 9, "en", "s", 1, 0, "k", 0, 0) for i in range(2000)] + [(None, "copy " * 9, "en", "s", 1, 0, "k", 0, 0)] * 3, corpus.schema))
    out = assign_shards(df, 16).collect()
    sizes = {i: len((t or "").encode()) + 1 for i, t in rows} | {10_000 + i: 46 for i in range(2000)} | {None: 46}
    assert Counter(r["doc_id"] for r in out) == Counter([i for i, _ in rows] + [10_000 + i for i in range(2000)] + [None] * 3)
    assert all(r["size"] == sizes[r["doc_id"]] and r["law"] == "bytes" and r["grown_shard"] is None for r in out)
    crc = {i: zlib.crc32((t or "").encode()) for i, t in rows}
    assert all(r["text_crc32"] == crc.get(r["doc_id"], zlib.crc32(b"copy " * 9)) for r in out)
    bytes_, slots = Counter(), defaultdict(list)
    for r in out:
        bytes_[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    even, most = sum(bytes_.values()) / 16, max(sizes.values())
    assert all(abs(bytes_[k] - even) <= most for k in range(16))
    assert assign_shards(empty(corpus)).collect() == []
    path = str(tmp_path / "shards")
    own = corpus.limit(40).withColumn("slot", F.lit("mine")).withColumn("shard", F.lit(7)).withColumn("own_id", F.col("doc_id") + 1).unionByName(corpus.limit(1).withColumns({"slot": F.lit(""), "shard": F.lit(0), "own_id": F.lit(0), "doc_id": F.lit(None).cast("bigint")}))
    write_shards(own, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 41 and sorted(back.columns) == sorted(own.columns) and dict(back.dtypes)["slot"] == "bigint"
    want = Counter((r["doc_id"], r["shard"], r["slot"]) for r in assign_shards(own, 4).collect())
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in back.collect()) == want and all(r["doc_id"] is None or r["own_id"] == r["doc_id"] + 1 for r in back.collect())
    write_shards(own.limit(0), path + "none", 4)


def test_hot_keys_are_subdivided(spark):
    from titlewright.llm.sharding import ranged, records

    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    sizes = [r["count"] for r in ranged(records(df)).groupBy("range").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 4 * 6000 / 64


# --- 1


@pytest.fixture(scope="module")
def cells(spark):
    rng = random.Random(1)
    return spark.createDataFrame([(f"s{a}", f"l{b}", f"t{c}", float(rng.randint(1, 1000)), 1) for a in range(5) for b in range(3) for c in range(2)], "source string, lang string, topic string, n double, n_rows bigint")


def shares(spark, name, ws):
    return spark.createDataFrame([(f"{name[0]}{i}", w / sum(ws)) for i, w in enumerate(ws)], f"{name} string, target double")


@pytest.mark.parametrize("small", [True, False])
def test_raking_meets_targets(spark, cells, monkeypatch, small):
    from titlewright.llm import mixing

    if not small:
        monkeypatch.setattr(mixing, "SMALL", 3)
    want = {"source": [1, 2, 3, 4, 5], "lang": [5, 1, 1], "topic": [1, 1]}
    raked, residual = mixing.rake(cells, {d: shares(spark, d, ws) for d, ws in want.items()}, tolerance=1e-9)
    assert residual <= 1e-9
    for d, ws in want.items():
        got = dict(map(tuple, raked.groupBy(d).agg(F.sum("w")).collect()))
        assert all(abs(got[f"{d[0]}{i}"] - w / sum(ws)) < 1e-8 for i, w in enumerate(ws))
    for share in (0.05, 0.4, 0.95):
        ps = mixing.calibrate(raked, share).collect()
        assert all(0 < r["p"] <= 1 for r in ps) and abs(sum(r["p"] * r["n"] for r in ps) / sum(r["n"] for r in ps) - share) < 1e-6
        open_ = {round(r["p"] * r["n"] / r["w"], 3) for r in ps if r["p"] < 1}
        assert len(open_) == 1 and (share < 0.9 or any(r["p"] == 1 for r in ps))
    assert all(r["p"] == 1 for r in mixing.calibrate(raked, 2.0).collect())


def test_targets_that_contradict_each_other(spark, cells):
    from titlewright.llm.mixing import rake

    few = cells.where("source <> 's0' or lang = 'l0'").where("lang <> 'l0' or source = 's0'")  # s0 and l0 are the same cells
    _, residual = rake(few, {"source": shares(spark, "source", [1, 1, 1, 1, 1]), "lang": shares(spark, "lang", [8, 1, 1])}, rounds=10)
    assert residual > 0.1
    _, residual = rake(cells, {"lang": shares(spark, "lang", [1, 1, 1, 1])})  # a target that no cell can meet
    assert residual > 0.2
    raked, residual = rake(cells.limit(0), {"lang": shares(spark, "lang", [1, 1])})
    assert raked.collect() == [] and residual == 1.0


@pytest.mark.parametrize("small", [True, False])
def test_mixing(spark, corpus, monkeypatch, small):
    from titlewright.llm import mixing

    if not small:
        monkeypatch.setattr(mixing, "SMALL", 3)
    tokens = mixing.token_count(F.col("text"))
    clash = {n: F.lit("x") for n in ("p", "selected", "cell_0", "cell_source", "own_row", "draw_id", "w", "n", "a.b")}
    own = corpus.select("doc_id", "lang", "source", "key", mixing.length_band(tokens).alias("topic"), tokens.alias("tokens")).withColumns(clash).repartition(3)
    got = mixing.mix_sources(own, share=0.5)
    assert got.columns == [c for c in own.columns if c not in ("p", "selected")] + ["p", "selected", "residual"]
    got = got.collect()
    assert len(got) == corpus.count() and all(r["cell_source"] == r["own_row"] == r["a.b"] == "x" for r in got)
    assert 0 < sum(r["selected"] for r in got) < len(got)
    total = sum(r["tokens"] for r in got)
    assert abs(sum(r["p"] * r["tokens"] for r in got) / total - 0.5) < 1e-6
    if small:
        again = {(r["doc_id"], r["p"], r["selected"]) for r in mixing.mix_sources(own, share=0.5).collect()}
        assert again == {(r["doc_id"], r["p"], r["selected"]) for r in got}
        assert mixing.mix_sources(own.limit(0)).collect() == []
        assert all(r["selected"] for r in mixing.mix_sources(own.where("tokens = 0")).collect())
        twice = own.where("doc_id = 20").unionByName(own.where("doc_id = 20")).withColumn("doc_id", F.lit(None).cast("bigint"))
        assert len({r["selected"] for r in mixing.mix_sources(twice).collect()}) == 1


# --- 5


@pytest.fixture(scope="module")
def labelled(spark):
    rng, v = random.Random(9), vocabulary(600, 7)
    docs, labels = [], []
    for i in range(1200):
        w = [rng.choice(v) for _ in range(rng.randint(10, 120))]
        toxic, low = i % 6 == 0, i % 4 == 1
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), f"vile{rng.randint(0, 30)}")
        if low:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w)))
        if i % 3 != 2 or i > 900:
            labels.append((i, int(low), int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame([*labels, (3, None, 1), (99_999, 1, 1), (None, 0, 0)], "doc_id bigint, low_quality int, toxic int")


def test_chain_on_held_out_rows(labelled):
    from titlewright.llm.toxicity import fit_chain, score_chain

    docs, labels = labelled
    model = fit_chain(docs, labels.where("doc_id < 900"), ("low_quality", "toxic"))
    got = {r["doc_id"]: r for r in score_chain(docs, model).collect()}
    held = [i for i in range(900, 1200)]
    assert sum(got[i]["toxic"] == (i % 6 == 0) for i in held) >= 297
    assert sum((got[i]["p_low_quality"] > 0.5) == (i % 4 == 1) for i in held) >= 295
    assert len(model.weights[1]) == len(model.weights[0]) + 1  # the later model sees the earlier probability


def test_chain_edges(spark, corpus, labelled):
    from titlewright.llm.toxicity import fit_chain, score_chain

    docs, labels = labelled
    nothing = fit_chain(docs, labels.limit(0), ("toxic",))
    assert {r["toxic"] for r in score_chain(docs, nothing).collect()} == {False}
    one = fit_chain(docs, labels.where("toxic = 0"), ("low_quality", "toxic"))
    assert not any(r["toxic"] for r in score_chain(docs, one).collect())
    model = fit_chain(docs, labels, ("low_quality", "toxic"))
    got = score_chain(corpus, model, keep=("doc_id", "key", "pos")).collect()
    assert len(got) == corpus.count() and not any(r["toxic"] for r in got)
    assert score_chain(empty(corpus), model).collect() == []
    twice = spark.createDataFrame([(1, None), (1, None), (None, "vile3 vile4 a b c d e f g h")], "doc_id bigint, text string")
    assert Counter((r["doc_id"], r["toxic"]) for r in score_chain(twice, model).collect()) == {(1, False): 2, (None, True): 1}


def test_chain_flags_what_it_is_sure_of(spark):
    from titlewright.llm.toxicity import fit_chain, score_chain

    rng, v = random.Random(12), vocabulary()
    docs, labels = [], []
    for i in range(900):  # of the toxic ones only a few can be told by their words
        w = [rng.choice(v) for _ in range(30)]
        if i % 20 == 0:
            w[3:3] = ["vile1", "vile2", "vile3"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = fit_chain(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"), ("toxic",))
    flagged = {r["doc_id"] for r in score_chain(df, model).where("toxic").collect()}
    assert model.accuracy[0] < 0.5 and flagged >= set(range(0, 900, 20)) and len(flagged) <= 55


def test_bpe_on_odd_strings():
    import public_tokenizers
    from tokenizers import Tokenizer

    from titlewright.llm.bpe import Encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    ref, own, rng = Tokenizer.from_file(path), Encoder(path, memo=100), random.Random(1)
    pieces = ["a", "B", "é", "日", "1", "½", "'", "s", " ", " ", " ", "\n", "\t", "\r", "\xa0", "　", " ", "\x1c", "\x85", "!", "'ll", "don't", "_", "<|endoftext|>", "\U0001f600", "́"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        ids = ref.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)
        assert own.decode(own.encode(text)) == text
    for n in (60, 64, 65, 66, 200, 5000):  # both ways of merging
        text = "".join(rng.choice("etaoinshrdlu") for _ in range(n))
        assert own.encode(text) == struct.pack(f"<{len(ref.encode(text).ids)}I", *ref.encode(text).ids)
