"""The whole build over a small batch of titles and one pass of votes, through the command line."""

import gzip
import hashlib
import json
import struct

from titlewright.cli import main
from titlewright.plans import build


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def title(i, name, keywords=(), genres=(28,), votes=1000, **more):
    return {"tmdbId": i, "mediaType": "movie", "title": name, "year": 1999, "overview": f"{name} is a story long enough to pass.", "genreIDs": list(genres), "genres": ["Action"], "keywordIDs": list(keywords), "keywords": [f"k{k}" for k in keywords], "originCountry": ["US"], "originalLanguage": "en", "voteCount": votes} | more


def ballot(i, primary, labels=(), moods=()):
    return {"tmdbId": i, "primary_genre": primary, "subgenres": list(labels), "moods": list(moods)}


#: 40 is a film and a series; the series alone has the keyword for zombies. 41 gets no genre, 43 no vote.
TITLES = [title(40, "Harbour", genres=(18,)), title(40, "Harbour Nights", [12377], (16, 18), mediaType="tv"), title(41, "Kiln"), title(42, "Orchard", [9672], (99,)), title(43, "Quarry")]
PASSES = [
    [ballot(42, "Documentary", ["Biopic"], [{"label": "Slow-burn", "confidence": 0.61}]), ballot(40, "Horror", [{"label": "Zombie", "confidence": 0.5}, {"label": "Political", "confidence": 0.56}], ["Cozy"]), ballot(41, "Anecdote"), ballot(42, "War")],
    [ballot(40, "Drama", [{"label": "Zombie", "confidence": 0.5}, {"label": "Political", "confidence": 0.6}], [{"label": "Cozy", "confidence": 0.4}])],
]


def test_assemble_finalize_publish_score(spark, tmp_path, capsys):
    put(tmp_path / "enriched/batch-7.json", TITLES)
    for n, rows in enumerate(PASSES, 1):
        put(tmp_path / f"votes/batch-7-pass{n}.json", rows)
    put(tmp_path / "votes/batch-7-pass3.json", '[{"tmdbId": 40, "subgenres": [{"confidence": 1}]}]')
    out = ["--out-dir", str(tmp_path)]
    assert main(["escalation", *out, "--batch-id", "7"], spark) == 0
    assert sorted((r["tmdbId"], r["mediaType"]) for r in json.loads((tmp_path / "escalate/batch-7.json").read_text())) == [(40, "movie"), (40, "tv"), (43, "movie")]
    assert main(["assemble", *out, "--batch-id", "7"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"batchId": 7, "classifiedTotal": 4, "noPrimary": 1, "missingVotes": 1}
    assert "bad-vote-pass batch-7-pass3.json" in "".join(f.read_text() for f in (tmp_path / "enrich-log.txt").glob("part-*"))
    assert main(["assemble", *out, "--batch-id", "7", "--force"], spark) == 0  # supersedes, changes nothing
    assert main(["publish", *out, "--to", str(tmp_path / "latest")], spark) == 1  # nothing is there yet
    assert main(["finalize", *out], spark) == 0
    labels = (tmp_path / "labels-t01.json").read_bytes()
    got = json.loads(labels)
    assert list(got) == ["count", "records", "taxonomyVersion"] and got["count"] == 3 and got["taxonomyVersion"] == "t01"
    found = {(r["mediaType"], r["tmdbId"]): (r["primaryGenre"], [(x["label"], x["confidence"]) for x in r["subgenres"]], [(x["label"], x["confidence"]) for x in r["moods"]], r["animated"]) for r in got["records"]}
    assert found == {
        ("movie", 40): ("Horror", [("Political", 0.5800000000000001)], [], False),
        ("tv", 40): ("Horror", [("Zombie", 0.6), ("Political", 0.5800000000000001)], [], True),
        ("movie", 42): ("Documentary", [("Biopic", 0.7999999999999999)], [("Slow-burn", 0.61)], False),
    }
    blob = (tmp_path / "vectors-e02.bin").read_bytes()
    assert struct.unpack("<ii", blob[:8]) == (3, 384) and len(blob) == 8 + 3 * 384
    meta = json.loads((tmp_path / "dataset.meta.json").read_text())
    assert len(meta) == 15 and meta["embeddingModel"] == "e02" and meta["quantization"] == "int8-symmetric-x127" and meta["dims"] == 384 and meta["count"] == 3
    assert meta["labelsSha256"] == hashlib.sha256(labels).hexdigest() and meta["vectorsBytes"] == len(blob) and len(meta["datasetVersion"]) == 12
    assert gzip.decompress((tmp_path / "labels-t01.json.gz").read_bytes()) == labels
    report = json.loads((tmp_path / "report.json").read_text())["report"]
    assert report["confidenceHistogram"] == {"0.5-0.6": 2, "0.6-0.7": 2, "0.7-0.8": 1} and report["byPrimaryGenre"] == {"Horror": 2, "Documentary": 1}
    assert main(["publish", *out, "--to", str(tmp_path / "latest")], spark) == 0
    assert {f.name for f in (tmp_path / "latest").iterdir() if not f.name.startswith(".")} == {"labels-t01.json", "labels-t01.json.gz", "vectors-e02.bin", "dataset.meta.json"} and (tmp_path / "latest/labels-t01.json").read_bytes() == labels
    golden = [{"tmdbId": 40, "mediaType": "tv", "title": "Harbour Nights", "primaryGenre": "Horror", "subgenres": [], "themes": ["Zombie"], "moods": ["Cozy"]}, {"tmdbId": 42, "mediaType": "tv", "title": "Other", "primaryGenre": "Drama", "subgenres": [], "themes": [], "moods": []}]
    put(tmp_path / "golden.json", {"taxonomyVersion": "t01", "titles": golden})
    args = ["score", "--labels", str(tmp_path / "labels-t01.json"), "--golden", str(tmp_path / "golden.json")]
    assert main(args, spark) == 0 and main([*args, "--gate"], spark) == 3
    assert "1 of 2 covered" in capsys.readouterr().out
    (tmp_path / "vectors-e02.bin").write_bytes(blob[:-1])
    (tmp_path / ".vectors-e02.bin.crc").unlink(missing_ok=True)
    assert main(["publish", *out, "--to", str(tmp_path / "latest")], spark) == 1
    assert "isn't what the manifest says" in capsys.readouterr().err and (tmp_path / "latest/vectors-e02.bin").read_bytes() == blob


def test_sources_of_votes(spark):
    import pytest

    from titlewright.operators import votes
    from titlewright.sources.readers import TITLE, snake

    t = snake(spark.createDataFrame(TITLES, TITLE))

    class Fixed(votes.VoteSource):
        def answers(self, requests, sample):
            from pyspark.sql import functions as F

            assert {"system", "user", "max_tokens", "temperature"} <= set(requests.columns)
            labels = '[{"label":"Zombie","confidence":0.6}]' if sample < 3 else '["Zombie"]'
            return requests.select("media_type", "tmdb_id", F.lit(f'{{"primary_genre":"Horror","subgenres":{labels}}}').alias("raw"))

    got = {(r["media_type"], r["tmdb_id"]): [(x["label"], x["confidence"]) for x in r["subgenres"]] for r in votes.classify_titles(t, Fixed(), 3).collect()}
    assert len(got) == 5 and got["tv", 40] == [("Zombie", 0.7)] and got["movie", 40] == [("Zombie", 0.6)]  # the third answer doesn't parse
    assert votes.ask(t, Fixed(), 0).select("pass").distinct().count() == 1
    with pytest.raises(NotImplementedError):
        votes.classify_titles(t, votes.NoVotes())


def test_artifacts_of_any_layout(spark, tmp_path):
    from titlewright.sources import readers

    label = lambda name: {"label": name, "confidence": 0.5}
    rows = [{"animated": False, "mediaType": "movie", "moods": [label('a},{"animated":true')], "primaryGenre": 'q"},{x', "source": "llm", "subgenres": [label(str(i))], "tmdbId": i} for i in range(7)]
    for n in (0, 1, 7):
        for name, text in (("own", json.dumps({"count": n, "records": rows[:n], "taxonomyVersion": "t01"}, separators=(",", ":"))), ("pretty", json.dumps({"taxonomyVersion": "t01", "count": n, "records": rows[:n]}, indent=1)), ("a.jsonl", "\n".join(map(json.dumps, rows[:n])))):
            put(tmp_path / f"{n}/{name}", text)
            got = readers.records(spark, str(tmp_path / f"{n}/{name}")).orderBy("tmdb_id").collect()
            assert [(r["tmdb_id"], r["primary_genre"], r["subgenres"][0]["label"], r["moods"][0]["label"]) for r in got] == [(r["tmdbId"], r["primaryGenre"], r["subgenres"][0]["label"], r["moods"][0]["label"]) for r in rows[:n]]


def test_lists_are_read_by_line(spark, tmp_path):
    """A list that has a line for each item is read an item at a time; any other layout gives the same rows."""
    from titlewright.plans.build import _votes
    from titlewright.sources import readers, sinks, storage

    rows = [title(i, f'T {i}"}},{{\n"', overview="],\n[" if i % 2 else None) for i in range(40)]
    path = str(tmp_path / "own x.json")
    assert sinks.write_list(spark.createDataFrame(rows, readers.TITLE).repartition(7).orderBy("tmdbId"), path) == 40
    text = (tmp_path / "own x.json").read_text()
    assert json.loads(text) == rows and text.startswith("[\n{") and text.endswith("}\n]\n") and len(text.split("\n")) == 43
    assert storage.sha256(spark, path) == hashlib.sha256(text.encode()).hexdigest()
    split = '[\n{"tmdbId":1,"x":[{"a":1},\n{"a":2}]},\n{"tmdbId":2}\n]'  # each line looks like an item
    layouts = {"lines": text, "dense": json.dumps(rows), "pretty": json.dumps(rows, indent=1), "split": split, "none": "[\n\n]\n", "comma": '[\n{"tmdbId":1},\n]\n', "cut": '[\n{"tmdbId":1},\n{"tmdb'}
    for name, content in layouts.items():
        put(tmp_path / "lists" / f"{name}.json", content)
    items, own, rest = readers.list_lines(spark, str(tmp_path / "lists/*.json"))
    assert sorted(p.rsplit("/")[-1] for p in own) == ["lines.json", "none.json"] and len(rest) == 5 and items.count() == 40
    want = [(r["tmdbId"], r["title"], r["overview"]) for r in rows]
    for name in ("lines", "dense", "pretty"):
        assert [tuple(r) for r in readers.titles(spark, str(tmp_path / f"lists/{name}.json")).select("tmdb_id", "title", "overview").collect()] == want
    assert [r[0] for r in readers.worklist(spark, str(tmp_path / "lists/split.json")).select("tmdb_id").collect()] == [1, 2]
    passes = [ballot(1, "War", ["Heist"]), ballot(2, None), ballot(1, "Drama")]
    for n, votes in enumerate((passes, [*passes, ballot(3, "War", [{"confidence": 1}])])):
        put(tmp_path / f"votes/dense{n}.json", votes)
        put(tmp_path / f"votes/lines{n}.json", "[\n" + ",\n".join(map(json.dumps, votes)) + "\n]\n")
    got = {}
    for r in _votes(spark, str(tmp_path / "votes/*.json")).orderBy("pos").collect():
        got.setdefault(r["file"], []).append((r["valid"], r["tmdb_id"], r["primary_genre"], r["subgenres"]))
    assert got["dense0.json"] == got["lines0.json"] and len(got["lines0.json"]) == 3 and all(x[0] for x in got["lines0.json"])
    assert got["dense1.json"] == got["lines1.json"] and not any(x[0] for x in got["lines1.json"])


def test_discover_pages_beyond_twenty(spark, tmp_path):
    """Of many titles the first pages have no film."""
    from tests_support import compare
    from titlewright.plans import artifacts, queries as core  # noqa: F401

    docs = spark.range(180_000).selectExpr("id AS doc_id", "'some text' AS text", "'en' AS lang", "'web' AS source", "9L AS n_chars")
    for t in ("region nation customer supplier part orders lineitem events embeddings pages benchmark labels conversations").split():
        (tmp_path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    compare(spark, "discover_pages", core.queries()["discover_pages"], core.oracle_sql()["discover_pages"], str(tmp_path))
    docs.where("doc_id % 400 = 27").toPandas().to_parquet(tmp_path / "documents.parquet")  # all are series
    compare(spark, "discover_pages", core.queries()["discover_pages"], core.oracle_sql()["discover_pages"], str(tmp_path))


def test_paging_stops(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual

    from titlewright.sources.catalogue import MOST_PAGES, _Reader, pages_in

    asked = []

    def fetch(params, page):
        asked.append(page)
        return {"total_pages": 9999, "results": [{"id": page * 2 // 2, "media_type": "tv", "origin_country": "FR", "vote_count": 1}]}

    assert len(list(_Reader(fetch, None).read(None))) == MOST_PAGES == len(asked)
    assert [r[4] for r in _Reader(fetch, 3).read(None)] == [1, 2, 3]
    row = lambda i, m, v: {"id": i, "media_type": m, "origin_country": "FR", "vote_count": v}
    put(tmp_path / "page-1.json", {"total_pages": 2, "results": [row(1, "tv", 9), row(2, "movie", 8), row(1, "tv", 9)]})
    put(tmp_path / "page-2.json", {"total_pages": 2, "results": [row(3, "tv", 5), row(4, "tv", 2)]})
    reader = _Reader(pages_in(f"file:{tmp_path}"), None)
    kept = list(reader.pushFilters([EqualTo(("media_type",), "tv"), GreaterThan(("vote_count",), 1), GreaterThanOrEqual(("vote_count",), 5)]))
    assert kept == [GreaterThan(("vote_count",), 1)] and reader.params == {"media_type": "tv", "vote_count.gte": 5}
    assert [r[0] for r in reader.read(None)] == [1, 3]


def test_worklist_and_enrich(spark, tmp_path, capsys):
    from titlewright.sources.readers import snake

    rows = [title(1, "Good"), title(2, "Low", votes=3), title(3, "Anime", [210024]), title(4, "Stub", overview=" x ")]
    schema = "tmdbId bigint, mediaType string, title string, year int, overview string, genreIDs array<bigint>, genres array<string>, keywordIDs array<bigint>, keywords array<string>, originCountry array<string>, originalLanguage string, voteCount bigint"
    cat = str(tmp_path / "catalogue")
    snake(spark.createDataFrame(rows, schema)).write.parquet(cat)
    put(tmp_path / "export.json", '{"id":1}\n\nbad\n{"id":2,"x":1}\n{"id":"3"}\n{"id":3}\n{"id":4}\n{"id":9}\n{"id":1}\n')
    work = str(tmp_path / "work.json")
    assert main(["worklist", "--mode", "export", "--file", str(tmp_path / "export.json"), "--out", work], spark) == 0
    assert [x["tmdbId"] for x in json.loads((tmp_path / "work.json").read_text())] == [1, 2, 3, 4, 9, 1]
    args = ["enrich", "--worklist", work, "--catalogue", cat, "--out-dir", str(tmp_path / "out"), "--limit", "4"]
    got = []
    for _ in range(3):
        assert main(args, spark) == 0
        got.append(json.loads(capsys.readouterr().out.splitlines()[-1]))
    assert {k: got[0][k] for k in ("batchId", "count", "belowFloor", "anime", "noOverview", "failures", "remaining")} == {"batchId": 0, "count": 1, "belowFloor": 1, "anime": 1, "noOverview": 1, "failures": 0, "remaining": 1}
    assert (got[1]["failures"], got[1]["remaining"]) == (1, 0) and got[2] == {"remaining": 0, "count": 0}
    assert main(["worklist", "--catalogue", cat, "--count", "2", "--vote-floor", "0", "--out", work], spark) == 0
    put(tmp_path / "ids.json", [{"tmdbId": 2}, {"tmdbId": 77}])
    assert build.enrich_ids(spark, str(tmp_path / "ids.json"), cat, str(tmp_path / "out"), 5) == {"batchId": 5, "requested": 2, "enriched": 1}


def test_exit_codes(spark, capsys):
    assert main([], spark) == 2 and main(["nope"], spark) == 2 and main(["finalize"], spark) == 1
    capsys.readouterr()
