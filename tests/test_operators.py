import numpy as np
from pyspark.sql import functions as F

from titlewright.functions.text import tokenize
from titlewright.operators import classify, discover, embed, enrich, score, store, votes
from titlewright.streaming.ledger import Ledger, run_incremental, windowed_counts

KEY = ["tmdb_id"]


def ballots(spark, rows):
    return spark.createDataFrame(rows, "tmdb_id bigint, pass int, primary_genre string")


def items(spark, rows):
    return spark.createDataFrame(rows, "tmdb_id bigint, pass int, pos int, label string, confidence double")


def titles(spark, rows):
    return spark.createDataFrame(rows, "tmdb_id bigint, keyword_ids array<bigint>")


def test_near_ties_go_to_the_rarer_genre(spark):
    genres = {1: ["Drama", "Western"], 2: ["Drama", "Drama", "Western"], 3: ["Drama", "Drama", "Western", "War"], 4: ["Drama"] * 3 + ["Western"] * 2, 5: ["Nope", None], 6: ["Adventure", "Romance"]}
    got = classify.fused_primary(ballots(spark, [(t, i, g) for t, gs in genres.items() for i, g in enumerate(gs)]), KEY)
    assert dict(map(tuple, got.collect())) == {1: "Western", 2: "Drama", 3: "Western", 4: "Western", 6: "Adventure"}


def test_three_votes_of_seven_tenths_miss_the_cutoff(spark):
    v = ballots(spark, [(1, p, "Drama") for p in (1, 2, 3)] + [(2, p, None) for p in (1, 2)])
    i = items(spark, [(1, p, 0, "Crime Thriller", 0.7) for p in (1, 2, 3)] + [(2, p, 0, "Crime Thriller", 0.7) for p in (1, 2)])
    got = classify.classify_axis(v, i, titles(spark, [(1, []), (2, [])]), KEY, "subgenres")
    assert [r["tmdb_id"] for r in got.collect()] == [2]


def test_grounding_and_denominator(spark):
    v = ballots(spark, [(1, 1, "Crime"), (1, 2, None)])
    i = items(spark, [(1, 1, 0, "Heist", 0.7), (1, 2, 0, "Heist", 0.7), (1, 1, 1, "Zombie", 1.0), (1, 1, 2, "heist", 1.0), (1, 1, 3, "K-Drama", 1.0), (1, 1, 4, "Slasher", 1.0), (1, 1, 5, "Slasher", 1.0), (1, 2, 5, "Slasher", 1.0)])
    got = {r["label"]: (r["confidence"], r["grounded"]) for r in classify.classify_axis(v, i, titles(spark, [(1, [10051, 12339])]), KEY, "subgenres").collect()}
    assert got == {"Heist": (0.7 + 0.1, True), "Slasher": (1.0, True)}
    assert 0.7 + 0.1 < 0.8


def test_confidence_over_one_without_grounding(spark):
    v, i = ballots(spark, [(1, 1, "Crime")]), items(spark, [(1, 1, 0, "Heist", 0.9), (1, 1, 1, "Heist", 0.9)])
    assert classify.classify_axis(v, i, titles(spark, [(1, None)]), KEY, "subgenres").first()["confidence"] == 1.8


def test_top_three_shared_by_both_families_with_ties_by_name(spark):
    labels = ["Zombie", "Vampire", "Crime Comedy", "Heist", "Musical"]
    v, i = ballots(spark, [(1, 1, "Crime")]), items(spark, [(1, 1, k, x, 0.9) for k, x in enumerate(labels)])
    got = classify.classify_axis(v, i, titles(spark, [(1, [])]), KEY, "subgenres").orderBy("rank").collect()
    assert [r["label"] for r in got] == ["Crime Comedy", "Heist", "Musical"]


def test_results_do_not_depend_on_partitions(spark):
    v = ballots(spark, [(t, p, ["Drama", "Crime", "War"][(t * p) % 3]) for t in range(40) for p in range(1, 4)])
    i = items(spark, [(t, p, k, ["Heist", "Zombie"][k], (t * 7 + p * 3 + k) % 10 / 10) for t in range(40) for p in range(1, 4) for k in range(2)])
    t = titles(spark, [(n, [10051] if n % 2 else []) for n in range(40)])
    rows = [sorted(map(tuple, classify.classify_axis(v.repartition(n), i.repartition(n + 1), t, KEY, "subgenres").collect())) for n in (1, 7)]
    assert rows[0] == rows[1] and rows[0]


def test_escalation(spark):
    first = spark.createDataFrame([(1, "Drama", []), (2, "Crime", []), (3, "Crime", [("Off", 0.6)]), (4, "Crime", [("Off", 0.6), ("X", 0.65)]), (5, None, []), (7, "Nope", [])], "tmdb_id bigint, primary_genre string, subgenres array<struct<label:string,confidence:double>>")
    got = classify.escalation(spark.range(1, 8).withColumnRenamed("id", "tmdb_id"), first, KEY)
    assert {r[0] for r in got.where("escalate").collect()} == {1, 3, 5, 6}


def test_anime_and_outcomes(spark):
    rows = [(1, 60, [16], "ja", [], "x" * 30), (2, 60, [16], None, [], "x" * 30), (3, 60, [], "en", [210024], "x" * 30), (4, 10, [16], "ja", [], ""), (5, 60, [], "en", [], "　  short  "), (6, None, None, None, None, None)]
    cat = spark.createDataFrame(rows, "tmdb_id bigint, vote_count bigint, genre_ids array<bigint>, original_language string, keyword_ids array<bigint>, overview string")
    work = spark.range(1, 8).withColumnRenamed("id", "tmdb_id")
    got = {r["tmdb_id"]: r["outcome"] for r in enrich.enrich(work, cat, KEY).collect()}
    assert got == {1: "anime", 2: "ok", 3: "anime", 4: "below_floor", 5: "no_overview", 6: "below_floor", 7: "failure"}


def test_wire_layouts(spark):
    movie = '{"id":1,"title":"","name":"N","release_date":"","first_air_date":"2001-01-01","keywords":{"keywords":[],"results":[{"id":1,"name":"a"}]},"production_countries":[{"iso_3166_1":"FR"}]}'
    tv = '{"id":2,"name":"S","first_air_date":"1999-05-01","keywords":{"results":[{"id":7,"name":"k"}]},"origin_country":[],"production_countries":[{"iso_3166_1":"FR"}],"vote_count":3,"genres":[{"id":18,"name":"Drama"}]}'
    a, b = enrich.normalize_wire(spark.createDataFrame([(movie,), (tv,)], "json string")).orderBy("tmdb_id").collect()
    assert (a["title"], a["year"], a["keyword_ids"], a["origin_country"], a["vote_count"], a["overview"]) == ("", None, [], ["FR"], 0, "")
    assert (b["title"], b["year"], b["keyword_ids"], b["origin_country"], b["genres"]) == ("S", 1999, [7], [], ["Drama"])


def test_discover_params_and_predicate(spark):
    spec = discover.DiscoverSpec("tv", genres=(1, 2), genre_join=discover.OR, without_genres=(3, 4), original_language="", release_date_gte="2000-01-01")
    assert list(spec.params().items()) == [("first_air_date.gte", "2000-01-01"), ("include_adult", "false"), ("sort_by", "popularity.desc"), ("with_genres", "1|2"), ("without_genres", "3,4")]
    rows = [(1, "tv", [1], "2001"), (2, "tv", [2, 4], "2001"), (3, "tv", [5], "2001"), (4, "movie", [1], "2001"), (5, "tv", [1], None)]
    cat = spark.createDataFrame(rows, "tmdb_id bigint, media_type string, genre_ids array<bigint>, release_date string")
    assert [r[0] for r in discover.discover(cat, spec).select("tmdb_id").collect()] == [1]


def test_votes_of_broken_files_are_left_out(spark):
    files = [("p1", '[{"tmdbId":1,"subgenres":[{"label":"A","confidence":null}]},{"tmdbId":1}]'), ("p10", "[]"), ("p2", '[{"subgenres":[]}]'), ("p3", '[{"tmdbId":1,"moods":[{"x":1}]}]'), ("p4", "{")]
    got = votes.first_votes(votes.decode_passes(spark.createDataFrame(files, "file string, json string"))).collect()
    assert [(r["tmdb_id"], r["pass"], r["subgenres"][0]["confidence"]) for r in got] == [(1, 1, 0.7)]


def test_strict_votes(spark):
    raws = ['x {"primary_genre":"A","subgenres":null} y', '{"subgenres":[{"label":"A"}]}', '{"subgenres":[{"label":"A","confidence":"0.9"}]}', "}{", None, '{"moods":[null]}']
    got = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, r string").select("i", votes.parse_strict(F.col("r")).alias("v")).orderBy("i").collect()
    assert [r["v"] is not None for r in got] == [True, False, False, False, False, False]


def test_embedding_against_numpy(spark):
    texts = {1: "A crew pulls off an elaborate diamond heist in Monte Carlo", 2: "zebra", 3: "", 4: None, 5: "the the THE cat"}
    df = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    got = {r[0]: r[1] for r in embed.HashingEmbedder().transform(df, ["id"], "text").select("id", "v").collect()}
    tokens = {r[0]: r[1] for r in df.select("id", tokenize(F.col("text"))).collect()}
    for i, ts in tokens.items():
        x = np.zeros(384, np.float32)
        for t in ts:
            h = 14695981039346656037
            for b in t.encode():
                h = (h ^ b) * 1099511628211 % (1 << 64)
            x[h % 384] += 1 if h >> 33 & 1 == 0 else -1
        norm = np.sqrt((x * x).sum(dtype=np.float32))
        y = np.float32(127) * (x / norm if norm else x)
        assert got[i] == np.clip(np.sign(y) * np.floor(np.abs(y.astype(float)) + 0.5), -127, 127).astype(int).tolist()
    assert sorted(map(abs, got[2]))[-2:] == [0, 127]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "z")], "k string, seq int, v string")
    assert sorted(map(tuple, store.keep_last(df, ["k"], "seq").collect())) == [("a", 3, None), ("b", 2, "z")]
    assert sorted(map(tuple, store.keep_first(df, ["k"], "seq").collect())) == [("a", 1, "x"), ("b", 2, "z")]


def test_alignment(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(1,), (3,)], "k int")
    assert tuple(store.alignment(a, b, ["k"]).first()) == (3, 2, 1, False)
    assert tuple(store.alignment(b, b, ["k"]).first()) == (2, 2, 2, True)
    assert tuple(store.alignment(b.limit(0), b.limit(0), ["k"]).first()) == (0, 0, 0, True)


def test_scores(spark):
    g = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A")], "tmdb_id int, label string")
    p = spark.createDataFrame([(1, "A"), (1, "C"), (1, "A")], "tmdb_id int, label string")
    labels = score.per_label(g, p, KEY)
    got = {r["label"]: (r["tp"], r["fp"], r["fn"], r["f1"]) for r in labels.collect()}
    assert got == {"A": (1, 0, 1, 2 / 3), "B": (0, 0, 1, 0.0), "C": (0, 1, 0, 0.0)}
    macro, micro = score.overall_f1(labels).first()
    assert abs(macro - 2 / 9) < 1e-12 and abs(micro - 0.4) < 1e-12
    assert tuple(score.overall_f1(labels.limit(0)).first()) == (0.0, 0.0)
    a = spark.createDataFrame([(1, "X"), (2, None), (3, "Y")], "tmdb_id int, primary_genre string")
    assert tuple(score.primary_accuracy(a, a.where("tmdb_id < 3"), KEY).first())[:2] == (3, 2)
    family = score.per_family(spark.createDataFrame([("Heist", 1, 0, 0), ("Cozy", 0, 0, 2), ("K-Drama", 1, 0, 0)], "label string, tp bigint, fp bigint, fn bigint"))
    assert {r["family"]: r["miss"] for r in family.collect()} == {"thematic": False, "moods": True}


def test_worklists(spark):
    rows = [(i, "movie", 1990 + i % 3, i * 10 % 70, [["FR"], ["ES", "FR"], ["DE"]][i % 3]) for i in range(1, 10)]
    cat = spark.createDataFrame(rows, "tmdb_id bigint, media_type string, year int, vote_count bigint, origin_country array<string>")
    assert [r[0] for r in discover.worklist_top(cat, 2, 0).collect()] == [6, 5]
    assert [r["year"] for r in discover.worklist_by_year(cat, 4, 0).collect()] == [1992, 1992, 1992, 1991]
    assert {r["tmdb_id"]: r["slice"] for r in discover.worklist_origins(cat, ["ES", "FR"], 0).collect()} == {1: 0, 3: 1, 4: 0, 6: 1, 7: 0, 9: 1}


def test_ledger_and_stream(spark, tmp_path):
    src, ledger = str(tmp_path / "in"), Ledger(spark, str(tmp_path / "ledger"))
    schema = "media_type string, tmdb_id bigint"
    step = lambda rows, n: rows.withColumn("outcome", F.lit(f"batch {n}"))
    for ids in ([1, 2, 2], [2, 3]):
        spark.createDataFrame([("movie", i) for i in ids], schema).write.mode("append").parquet(src)
        run_incremental(spark.readStream.schema(schema).parquet(src), ledger, str(tmp_path / "check"), step)
    assert sorted((r["tmdb_id"], r["outcome"]) for r in ledger.read().collect()) == [(1, "batch 0"), (2, "batch 0"), (3, "batch 1")]
    assert ledger.next_batch() == 2


def test_windowed_counts(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = windowed_counts(events)
    assert got.agg(F.sum("n")).first()[0] == events.count()
