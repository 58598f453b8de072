"""The registered queries that SQL can't express, and the pipeline, against brute force on the smallest tables."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from test_llm_operators import brute_near, line_key, words
from tokenizers import Tokenizer

import corpus_pipeline
from titlewright.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def coded(ref, text):
    ids = ref.encode(text or "", add_special_tokens=False).ids
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(ref.decode(ids, skip_special_tokens=False).encode())


def brute_scores(model, text):
    """Probabilities and the last category's flag of a text, by a plain sum over its words."""
    raw = (text or "").lower()
    every = "".join(" " if ord(c) < 128 and not c.isalnum() else c for c in raw).encode().split()
    once = {w.decode() for w in every}
    seen = {zlib.crc32(w.encode(), 99) for w in once} | {zlib.crc32(w[:n].encode(), n) for w in once for n in (4, 5, 6) if len(w) >= n}
    data = (text or "").encode()
    size = max(1, len(data))
    upper, marks = sum(65 <= b <= 90 for b in data), sum(33 <= b < 127 and not chr(b).isalnum() for b in data)
    x = [0.0] * len(model.vocabulary) + [min(12.0, np.log1p(len(every))) / 12, len(once) / max(1, len(every)), upper / size, marks / size, min(1.0, 20 * (data.count(b"\n") + 1) / size)]
    for h, i in model.vocabulary.items():
        x[i] = float(h in seen)
    out = []
    for w in model.weights:
        z = sum(a * b for a, b in zip([*x, *out], w[:-1], strict=True)) + w[-1]
        out.append(1 / (1 + np.exp(-min(30, max(-30, z)))))
    return out, out[-1] >= model.thresholds[-1]


def test_op5(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in queries.op5_toxicity(spark, SF).collect()}
    model = queries.toxicity_model(spark, SF, docs)
    rows = docs.collect()
    assert set(got) == {r["doc_id"] for r in rows} and model.categories == ("unfit", "low_quality", "toxic") and [len(w) - len(model.weights[0]) for w in model.weights] == [0, 1, 2]
    for r in rows:
        p, flag = brute_scores(model, r["text"])
        g = got[r["doc_id"]]
        assert all(abs(g[f"p_{c}"] - x) < 2e-6 for c, x in zip(model.categories, p)) and g["toxic"] == flag != g["kept"] and g["f1"] == round(model.accuracy[-1], 6)


def test_op5_on_held_out_labels(spark, tmp_path):
    """Fitted on three quarters of the labels, and compared on the rest with a fit of another kind: the share of toxic rows among
    those that have a word, summed as log odds."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    labels.where("doc_id % 4 <> 0").write.parquet(f"{tmp_path}/labels.parquet")
    from titlewright.llm.toxicity import score_chain

    scored = score_chain(docs, queries.toxicity_model(spark, str(tmp_path), docs))
    flagged = {r["doc_id"] for r in scored.where("toxic and doc_id % 4 = 0").collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = {i: t for i, t in truth.items() if i % 4 == 0}
    hits = sum(held[i] for i in flagged if i in held)
    recall, precision = hits / sum(held.values()), hits / sum(i in held for i in flagged)
    assert recall >= 0.85 and precision >= 0.93
    text = {r["doc_id"]: set((r["text"] or "").lower().split()) for r in docs.join(labels, "doc_id", "left_semi").collect()}
    seen, bad = defaultdict(int), defaultdict(int)
    for i, t in truth.items():
        if i % 4 and i in text:
            for w in text[i]:
                seen[w] += 1
                bad[w] += t
    rate = sum(t for i, t in truth.items() if i % 4) / sum(1 for i in truth if i % 4)
    odds = {w: np.log((bad[w] + rate) / (seen[w] - bad[w] + 1 - rate)) - np.log(rate / (1 - rate)) for w in seen if seen[w] >= 5}
    naive = {i: max([odds.get(w, 0.0) for w in text.get(i, ())] or [0.0]) for i in held}
    n = sum(i in held for i in flagged)
    guess = sorted(naive, key=lambda i: -naive[i])[:n]
    assert hits >= sum(held[i] for i in guess)


def test_op7(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    got = defaultdict(list)
    for r in queries.op7_neighbours(spark, SF).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in x:
        if q % 20 == 0:
            want = sorted((i for i in x if i != q), key=lambda i: (-(x[i] * x[q]).sum(), i))[:20]
            assert sorted(k for k, _, _ in got[q]) == list(range(1, len(want) + 1))
            assert all(abs(s - (x[i] * x[q]).sum()) < 1e-12 for _, i, s in got[q])
            hits += len(set(want) & {i for _, i, _ in got[q]})
            total += len(want)
    assert hits >= 0.9 * total


def packets(ts):
    """(PID, unit start, random access, payload) of each packet of a transport stream."""
    for i in range(0, len(ts), 188):
        p = ts[i : i + 188]
        assert len(p) == 188 and p[0] == 0x47
        begin, random_access = 4, False
        if p[3] & 0x20:
            begin = 5 + p[4]
            random_access = p[4] > 0 and bool(p[5] & 0x40)
        yield (p[1] << 8 | p[2]) & 0x1FFF, bool(p[1] & 0x40), random_access, i, p[begin:] if p[3] & 0x10 else b""


def test_op9(spark):
    from titlewright.llm.transport import DATA_PID, store_transport

    got = {r["doc_id"]: r for r in queries.op9_media_columns(spark, SF).collect()}
    media = {r["doc_id"]: bytes(r["media"]) for r in store_transport(documents(spark)).collect()}
    for r in documents(spark).collect():
        raw = (r["text"] or "").encode()
        full = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        g, ts = got[r["doc_id"]], media[r["doc_id"]]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
        assert (g["media_bytes"], g["media_sha256"]) == (len(ts), hashlib.sha256(ts).hexdigest())
        mine = [p for p in packets(ts) if p[0] == DATA_PID]
        units, data = [], b""
        for _, start, random_access, at, body in mine:
            if start:  # a header of nine bytes and the time stamp behind it
                pts = body[9:14]
                units.append((((pts[0] >> 1) & 7) << 30 | pts[1] << 22 | (pts[2] >> 1) << 15 | pts[3] << 7 | pts[4] >> 1, random_access, at))
                body = body[9 + body[8] :]
            data += body
        assert data == full
        feature = dict(x.split("=") for x in g["feature"].split(";"))
        points = [(t, at) for t, access, at in units if access]
        assert [(p["pts"], p["offset"]) for p in g["points"]] == points and points
        assert feature == {"streams": "1", "kind": "6", "packets": str(len(ts) // 188), "units": str(len(units)), "points": str(len(points)), "first": str(units[0][0]), "last": str(units[-1][0]), "lost": "0", "broken": "0"}


def test_op10(spark):
    ref = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op10_bpe(spark, SF).collect()}
    assert got == {r["doc_id"]: coded(ref, r["text"]) for r in documents(spark).collect()}


def brute_mix(rows):
    """Of (doc_id, text, lang, source) those that are drawn."""
    count = {r[0]: len(words(r[1])) for r in rows}
    band = lambda k: next((n for most, n in mixing.BANDS if k <= most), "long")
    cell = {i: (s or "(none)", g or "(none)", band(count[i])) for i, _, g, s in rows}
    n = defaultdict(float)
    for i, k in count.items():
        n[cell[i]] += k
    targets = []
    for d in range(3):
        sums = defaultdict(float)
        for c, k in n.items():
            sums[c[d]] += k
        powers = {v: s**mixing.ALPHA for v, s in sums.items()}
        targets.append({v: p / sum(powers.values()) for v, p in powers.items()})
    w = dict(n)
    for _ in range(60):
        for d in range(3):
            have = defaultdict(float)
            for c, k in w.items():
                have[c[d]] += k
            w = {c: k * targets[d][c[d]] / have[c[d]] if have[c[d]] else 0.0 for c, k in w.items()}
    low, high = 0.0, 1e12
    for _ in range(200):  # the factor by bisection
        factor = (low + high) / 2
        drawn = sum(min(n[c], factor * w[c]) for c in n)
        low, high = (factor, high) if drawn < mixing.SHARE * sum(n.values()) else (low, factor)
    p = {c: min(1.0, factor * w[c] / n[c]) if n[c] else 1.0 for c in n}
    draw = lambda i: int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2**52
    return [r for r in rows if draw(r[0]) < p[cell[r[0]]]]


def test_pipeline(spark):
    docs = documents(spark)
    model = queries.toxicity_model(spark, SF, docs)
    clean = [r for r in docs.collect() if not brute_scores(model, r["text"])[1]]
    assert 0 < len(clean) < docs.count()
    holds = defaultdict(set)
    for r in clean:
        for x in r["text"].split("\n"):
            if len(line_key(x)) >= 40:
                holds[line_key(x)].add(r["doc_id"])
    cut = [(r["doc_id"], "\n".join(x for x in r["text"].split("\n") if len(holds.get(line_key(x), ())) < 5 or r["doc_id"] == max(holds[line_key(x)])), r["lang"], r["source"]) for r in clean]
    near = brute_near([(i, t) for i, t, _, _ in cut])
    single = [r for r in cut if near[r[0]][1] == r[0]]
    ref = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: coded(ref, t) for i, t, _, _ in brute_mix(single)}
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and len(want) > 20
