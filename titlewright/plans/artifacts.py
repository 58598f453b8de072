"""Registered queries that go through the build's files: batches, vote passes, store, ledger and what is published.

A build of the whole documents table is made once for a session and table, in the shared folder. Its titles are the adapters', all
as films, and every third id as a series too, with other keywords; votes know ids only.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.functions.text import register_sql
from titlewright.operators import votes
from titlewright.operators.store import KEY
from titlewright.plans import build
from titlewright.plans.adapters import adapted
from titlewright.plans.queries import _CLASSIFY, ballots, golden, mood_items, query, records, subgenre_items, table, titles
from titlewright.session import scratch
from titlewright.sources import catalogue, readers, sinks, storage

_BUILT: dict[tuple[str, str], str] = {}

#: titles by media type and id, their keywords, records with their labels.
_MIXED = (
    _CLASSIFY
    + """, mt AS (SELECT tmdb_id, 'movie' AS media_type FROM titles UNION ALL SELECT tmdb_id, 'tv' FROM titles WHERE tmdb_id % 3 = 0),
mk AS (SELECT tmdb_id, 'movie' AS media_type, grounds FROM title_keywords WHERE grounds <> '' UNION SELECT t.tmdb_id, 'tv', d.grounds FROM titles t CROSS JOIN three p JOIN kw_dim d ON d.ki = ((t.tmdb_id + 1) * 3 + p.k * 7) % 24 WHERE t.tmdb_id % 3 = 0 AND d.grounds <> ''),
mc AS (SELECT m.media_type, a.tmdb_id, a.label, a.thr, CASE WHEN k.grounds IS NOT NULL THEN least(1::DOUBLE, a.c0 + 0.1::DOUBLE) ELSE a.c0 END AS c FROM mt m JOIN agg a USING (tmdb_id) LEFT JOIN mk k ON k.media_type = m.media_type AND k.tmdb_id = m.tmdb_id AND k.grounds = lower(a.label)),
ml AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY media_type, tmdb_id ORDER BY c DESC, label) AS rn FROM mc WHERE c >= thr) WHERE rn <= 3),
mr AS (SELECT m.media_type, m.tmdb_id, p.primary_genre, coalesce((SELECT string_agg(label, '|' ORDER BY rn) FROM ml WHERE ml.media_type = m.media_type AND ml.tmdb_id = m.tmdb_id), '') AS subgenres,
  coalesce((SELECT string_agg(label, '|' ORDER BY rn) FROM mtop WHERE mtop.tmdb_id = m.tmdb_id), '') AS moods FROM mt m JOIN prim p USING (tmdb_id))
"""
)
_RECORDS = _MIXED + "SELECT media_type, tmdb_id, primary_genre, subgenres, moods FROM mr"


def _mixed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a batch for both media types."""
    t = titles(spark, sf_dir).drop("media_type")
    other = adapted(spark, sf_dir, "SELECT t.tmdb_id, p.k AS pos, CAST(d.keyword_id AS BIGINT) AS keyword_id FROM titles t CROSS JOIN three p JOIN kw_dim d ON d.ki = ((t.tmdb_id + 1) * 3 + p.k * 7) % 24")
    other = other.groupBy("tmdb_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "keyword_id"))), lambda x: x["keyword_id"]).alias("keyword_ids"))
    series = t.where("tmdb_id % 3 = 0").drop("keyword_ids").join(other, "tmdb_id", "left").withColumn("keyword_ids", F.coalesce("keyword_ids", F.array().cast("array<bigint>")))
    both = t.withColumn("media_type", F.lit("movie")).unionByName(series.withColumn("media_type", F.lit("tv")))
    return both.withColumn("keywords", F.transform("keyword_ids", lambda k: F.concat(F.lit("k"), k.cast("string"))))


def _vote_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tmdb_id, pass and a vote's fields as the files have them."""
    none = F.array().cast("array<struct<label:string,confidence:double>>")
    out = ballots(spark, sf_dir)
    for axis, items in (("subgenres", subgenre_items(spark, sf_dir)), ("moods", mood_items(spark, sf_dir))):
        listed = items.groupBy("tmdb_id", "pass").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label", "confidence"))), lambda x: F.struct(x["label"].alias("label"), x["confidence"].alias("confidence"))).alias(axis))
        out = out.join(listed, ["tmdb_id", "pass"], "left").withColumn(axis, F.coalesce(axis, none))
    return out


def built(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the build: batch 0 of all titles, its three passes (and one that can't be read), assembled."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        out = scratch(spark, "build")
        at = build.Layout(out)
        build._write_titles(_mixed_titles(spark, sf_dir), at.enriched(0))
        rows = _vote_rows(spark, sf_dir).withColumnRenamed("tmdb_id", "tmdbId")
        for p in (1, 2, 3):
            sinks.write_list(rows.where(F.col("pass") == p).drop("pass").orderBy("tmdbId"), at.votes(0, str(p)))
        storage.write_file(spark, at.votes(0, "4"), [b"not a list"])
        build.assemble(spark, out, 0)
        _BUILT[key] = out
    return _BUILT[key]


def _finalized(spark: SparkSession, sf_dir: str) -> str:
    out = built(spark, sf_dir)
    if not storage.exists(spark, build.Layout(out).meta):
        build.finalize(spark, out, datetime(2026, 1, 2, 3, 4, 5))
    return out


def _digest(rows: DataFrame) -> DataFrame:
    names = lambda c: F.array_join(F.transform(c, lambda x: x["label"]), "|").alias(c)
    return rows.select(*KEY, "primary_genre", names("subgenres"), names("moods"))


@query(_RECORDS, adapters=True)
def assemble_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(build.read_store(spark, built(spark, sf_dir)))


@query(_RECORDS, adapters=True)
def artifact_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(readers.records(spark, build.Layout(_finalized(spark, sf_dir)).labels))


@query(_MIXED + "SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN p.tmdb_id IS NULL THEN 'no_primary' ELSE 'ok' END AS outcome FROM mt JOIN (SELECT DISTINCT tmdb_id FROM votes) v USING (tmdb_id) LEFT JOIN prim p USING (tmdb_id)) GROUP BY outcome", adapters=True)
def classify_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from titlewright.streaming.ledger import Ledger

    return Ledger(spark, build.Layout(built(spark, sf_dir)).classify_ledger).read().groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT v.tmdb_id, v.pass::INT AS pass, g.genre AS primary_genre, CASE WHEN v.tmdb_id % 17 = 0 THEN 0 ELSE 3 END AS n_subgenres, 3 AS n_moods FROM votes v LEFT JOIN genre_dim g USING (gi)", adapters=True)
def vote_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = votes.first_votes(build._passes(spark, build.Layout(built(spark, sf_dir)), 0))
    return first.select("tmdb_id", "pass", "primary_genre", F.size("subgenres").alias("n_subgenres"), F.size("moods").alias("n_moods"))


@query("SELECT tmdb_id, media_type, md5(overview) AS overview, vote_count, original_language, n_genres, n_keywords FROM (SELECT t.tmdb_id, m.media_type, t.overview, t.vote_count, t.original_language, (SELECT count(*) FROM title_genres g WHERE g.tmdb_id = t.tmdb_id)::INT AS n_genres, (SELECT count(*) FROM three p JOIN kw_dim d ON d.ki = ((t.tmdb_id + CASE m.media_type WHEN 'tv' THEN 1 ELSE 0 END) * 3 + p.k * 7) % 24)::INT AS n_keywords FROM titles t JOIN (SELECT 'movie' AS media_type UNION ALL SELECT 'tv') m ON m.media_type = 'movie' OR t.tmdb_id % 3 = 0)", adapters=True)
def batch_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = readers.titles(spark, build.Layout(built(spark, sf_dir)).enriched(0))
    return t.select("tmdb_id", "media_type", F.md5("overview").alias("overview"), "vote_count", "original_language", F.size("genre_ids").alias("n_genres"), F.size("keyword_ids").alias("n_keywords"))


@query(""", m AS (SELECT tmdb_id, max(conf) AS c FROM vote_items WHERE pass = 1 GROUP BY 1), v AS (SELECT v.tmdb_id, g.genre FROM votes v LEFT JOIN genre_dim g USING (gi) WHERE pass = 1)
SELECT t.tmdb_id, k.media_type FROM titles t JOIN (SELECT 'movie' AS media_type UNION ALL SELECT 'tv') k ON k.media_type = 'movie' OR t.tmdb_id % 3 = 0 LEFT JOIN v USING (tmdb_id) LEFT JOIN m USING (tmdb_id)
WHERE v.tmdb_id IS NULL OR v.genre IS NULL OR v.genre IN ('Drama', 'Comedy', 'Thriller') OR coalesce(m.c < 0.65, false)""", adapters=True)
def escalation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = build.escalation(spark, built(spark, sf_dir), 0)
    return readers.titles(spark, got["file"]).select("tmdb_id", "media_type")


@query(_MIXED + "SELECT count(*) AS count, 384 AS dims, 15 AS fields, 8 + 384 * count(*) AS vectors_bytes, true AS hashes, true AS version, true AS gzip, true AS aligned, '2026-01-02T03:04:05Z' AS built FROM mr", adapters=True)
def finalize_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, held against the files that it describes."""
    at = build.Layout(_finalized(spark, sf_dir))
    meta = spark.read.option("multiLine", True).json(at.meta)
    labels, vectors = F.lit(storage.sha256(spark, at.labels)), F.lit(storage.sha256(spark, at.vectors))
    unzipped, head = storage.sha256(spark, at.labels + ".gz", unzip=True), storage.head(spark, at.vectors, 8)
    hashes = (labels == F.col("labelsSha256")) & (vectors == F.col("vectorsSha256")) & (F.lit(storage.size(spark, at.labels)) == F.col("labelsBytes")) & (F.lit(storage.size(spark, at.vectors)) == F.col("vectorsBytes"))
    aligned = (F.lit(int.from_bytes(head[:4], "little")) == F.col("count")) & (F.lit(int.from_bytes(head[4:], "little")) == F.col("dims"))
    return meta.select(
        "count", F.col("dims").cast("int").alias("dims"), F.lit(len(meta.columns)).alias("fields"), F.col("vectorsBytes").alias("vectors_bytes"), hashes.alias("hashes"), (F.col("datasetVersion") == sinks.version_of(labels, vectors)).alias("version"),
        (F.lit(unzipped) == labels).alias("gzip"), aligned.alias("aligned"), F.col("builtAt").alias("built"),
    )


@query("SELECT * FROM (VALUES ('dataset.meta.json', true), ('labels-t01.json', true), ('labels-t01.json.gz', true), ('vectors-e02.bin', true)) AS f(name, same)")
def publish_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, to = _finalized(spark, sf_dir), scratch(spark, "release")
    sizes = build.publish(spark, out, to)
    found = spark.read.format("binaryFile").load(to).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("name"))
    return found.select("name", (F.col("length") == size).alias("same"))


@query(_CLASSIFY + """, s AS (SELECT avg(f1) AS m, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM pf), a AS (SELECT count(*) AS covered, count(*) FILTER (d.genre = p.primary_genre) AS hits FROM gold g JOIN genre_dim d USING (gi) JOIN prim p USING (tmdb_id))
SELECT covered, (SELECT count(*) FROM golden) AS total, round(hits / covered, 6)::DOUBLE AS accuracy, round(m, 6)::DOUBLE AS macro, round(2 * tp / (2 * tp + fp + fn), 6)::DOUBLE AS micro FROM a, s""", adapters=True)
def score_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = build.Layout(_finalized(spark, sf_dir))
    rows = golden(spark, sf_dir).select(F.col("tmdb_id").alias("tmdbId"), F.lit("movie").alias("mediaType"), F.col("primary_genre").alias("primaryGenre"), F.array("l1").alias("subgenres"), F.array("l2").alias("themes"), F.array("l3").alias("moods"))
    path = scratch(spark, "golden")
    storage.write_rows(spark, path, sinks.json_line(rows), ",\n", b'{"taxonomyVersion":"t01","titles":[\n', b"\n]}\n")
    s = build.score_labels(spark, at.labels, path)
    return spark.createDataFrame([(s["covered"], s["total"], s["accuracy"], s["macro"], s["micro"])], "covered bigint, total bigint, accuracy double, macro double, micro double").select("covered", "total", *[F.round(c, 6).alias(c) for c in ("accuracy", "macro", "micro")])


_OUTCOME = """CASE WHEN t.tmdb_id IS NULL THEN 'failure' WHEN vote_count < 50 THEN 'below_floor'
WHEN EXISTS (SELECT 1 FROM title_keywords k WHERE k.tmdb_id = t.tmdb_id AND k.keyword_id = 210024) OR (original_language = 'ja' AND EXISTS (SELECT 1 FROM title_genres g WHERE g.tmdb_id = t.tmdb_id AND g.genre_id = 16)) THEN 'anime'
WHEN length(trim(overview, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))) < 20 THEN 'no_overview' ELSE 'ok' END"""


def _catalogue_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A catalogue as Parquet and a worklist that has all its ids and as many that it lacks, with repeats."""
    cat, work = scratch(spark, "catalogue"), scratch(spark, "worklist")
    t = titles(spark, sf_dir).withColumn("keywords", F.transform("keyword_ids", lambda k: F.concat(F.lit("k"), k.cast("string")))).withColumn("release_date", F.concat(F.col("year").cast("string"), F.lit("-06-01")))
    t.write.parquet(cat)
    own = t.select(F.col("tmdb_id").alias("tmdbId"), F.col("media_type").alias("mediaType"))
    every = own.unionByName(own.withColumn("tmdbId", F.col("tmdbId") + 1_000_000)).unionByName(own.where("tmdbId % 7 = 0"))
    sinks.write_list(every.orderBy("tmdbId"), work)
    return cat, work


@query(f""", w AS (SELECT tmdb_id AS id, (row_number() OVER (ORDER BY tmdb_id) - 1) // 70 AS batch_id FROM (SELECT tmdb_id FROM titles UNION ALL SELECT tmdb_id + 1000000 FROM titles))
SELECT batch_id::INT AS batch_id, outcome, count(*) AS n FROM (SELECT w.batch_id, {_OUTCOME} AS outcome FROM w LEFT JOIN titles t ON t.tmdb_id = w.id WHERE w.batch_id < 2) GROUP BY ALL""", adapters=True)
def enrich_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after two calls for the next 70 ids."""
    from titlewright.streaming.ledger import Ledger

    cat, work = _catalogue_files(spark, sf_dir)
    out = scratch(spark, "enrich")
    for _ in range(2):
        build.enrich_batch(spark, work, cat, out, limit=70)
    return Ledger(spark, build.Layout(out).enrich_ledger).read().groupBy("batch_id", "outcome").agg(F.count("*").alias("n"))


@query("SELECT tmdb_id, media_type FROM titles WHERE vote_count >= 50 AND media_type = 'tv' ORDER BY vote_count DESC, tmdb_id LIMIT 60", adapters=True)
def worklist_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat, _ = _catalogue_files(spark, sf_dir)
    out = scratch(spark, "worklist")
    build.worklist(spark, cat, out, media="tv", count=60)
    return readers.worklist(spark, out)


@query("SELECT (SELECT count(*) FROM labels) AS requested, count(*) AS enriched, count(*) AS written FROM labels l JOIN titles t ON t.tmdb_id = l.doc_id AND t.media_type = 'movie'", adapters=True)
def enrich_ids_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat, _ = _catalogue_files(spark, sf_dir)
    ids, out = scratch(spark, "ids"), scratch(spark, "enrich")
    sinks.write_list(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("tmdbId")), ids)
    got = build.enrich_ids(spark, ids, cat, out, 3)
    written = readers.titles(spark, build.Layout(out).enriched(3))
    return written.agg(F.lit(got["requested"]).cast("bigint").alias("requested"), F.lit(got["enriched"]).cast("bigint").alias("enriched"), F.count("*").alias("written"))


class _Answers(votes.VoteSource):
    """The adapters' votes as prose, one sample for each pass."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.withColumn("raw", F.concat(F.lit("Sure!\n```json\n"), F.to_json(F.struct("primary_genre", "subgenres", "moods")), F.lit("\n```")))

    def answers(self, requests: DataFrame, sample: int) -> DataFrame:
        return requests.join(self.rows.where(F.col("pass") == sample).select("tmdb_id", "raw"), "tmdb_id").select(*KEY, "raw")


@query(_RECORDS, adapters=True)
def classify_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(votes.classify_titles(_mixed_titles(spark, sf_dir), _Answers(_vote_rows(spark, sf_dir)), 3))


@query(_CLASSIFY + "SELECT count(*) AS records, count(*) FILTER (tmdb_id % 10 = 0) AS leaking, true AS refused FROM prim", adapters=True)
def leak_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some hold raw text: they are counted, and the labels file isn't written."""
    some = records(spark, sf_dir).withColumn("source", F.when(F.col("tmdb_id") % 10 == 0, "overview of it").otherwise(F.col("source")))
    path = scratch(spark, "labels")
    try:
        sinks.write_labels(some, path, "t01", 1)
        refused = False
    except ValueError:
        refused = not storage.exists(spark, path)
    return sinks.leaks(sinks.record_json(some)).withColumn("refused", F.lit(refused))


@query("SELECT doc_id, '{\"doc_id\":' || doc_id || ',\"lang\":' || coalesce('\"' || lang || '\"', 'null') || ',\"n_chars\":' || n_chars || ',\"none\":null,\"source\":' || coalesce('\"' || source || '\"', 'null') || '}' AS json FROM documents")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of lines, written and read again."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "lang", "n_chars", F.lit(None).cast("string").alias("none"))
    path = scratch(spark, "lines")
    for part in (0, 1):  # lines are added to what is there
        sinks.json_line(docs.where(F.col("doc_id") % 2 == part)).write.mode("append").text(path)
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"), F.col("value").alias("json"))


@query("SELECT (props::JSON ->> '$.k')::BIGINT AS tmdb_id, count(*) AS n FROM events WHERE json_valid(props) AND json_type(props::JSON, '$.k') IN ('BIGINT', 'UBIGINT') GROUP BY 1")
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of lines, some empty and some broken, written and scanned."""
    path = scratch(spark, "export")
    line = F.when(F.col("event_id") % 50 == 7, "").when(F.col("event_id") % 50 == 8, '{"id":').otherwise("")
    good = table(spark, sf_dir, "events").select(F.replace("props", F.lit('"k"'), F.lit('"id"')).alias("value"))
    good.unionByName(table(spark, sf_dir, "events").where("event_id % 50 in (7, 8)").select(line.alias("value"))).write.text(path)
    return readers.export_ids(spark, path, "movie").groupBy("tmdb_id").agg(F.count("*").alias("n"))


@query("SELECT doc_id, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))::INT AS tokens, printf('%.1f-%.1f', floor(n_chars % 10) / 10, floor(n_chars % 10) / 10 + 0.1) AS bucket FROM documents")
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql(spark)
    docs = table(spark, sf_dir, "documents")
    return spark.sql("SELECT doc_id, size(tw_tokenize(text)) AS tokens, tw_confidence_bucket((n_chars % 10 + 0.5D) / 10D) AS bucket FROM {docs}", docs=docs)


@query(""", r AS (SELECT tmdb_id, media_type, origin_country, vote_count, ((row_number() OVER (ORDER BY vote_count DESC, tmdb_id) - 1) // 20 + 1)::INT AS page FROM titles),
k AS (SELECT *, coalesce(max(n) OVER (ORDER BY page RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT *, row_number() OVER (ORDER BY page, vote_count DESC, tmdb_id) AS n FROM r WHERE media_type = 'movie' AND vote_count >= 50))
SELECT tmdb_id, vote_count, page FROM k WHERE page <= 500 AND before < 45""", adapters=True)
def discover_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 20 titles by votes; the filters go to the source, which ends with the page that makes 45 films of 50 votes or more."""
    path = scratch(spark, "pages")
    rows = titles(spark, sf_dir).select(F.col("tmdb_id").alias("id"), "media_type", F.col("origin_country")[0].alias("origin_country"), "vote_count").orderBy(F.desc("vote_count"), "id").limit(20 * catalogue.MOST_PAGES).collect()  # what a catalogue serves
    pages = [rows[i : i + 20] for i in range(0, len(rows), 20)]
    for n, page in enumerate(pages, 1):
        sinks.write_json(spark, {"total_pages": len(pages), "results": [r.asDict() for r in page]}, f"{path}/page-{n}.json", False)
    catalogue.register(spark)
    got = spark.read.format("titlewright_pages").option("path", path).option("target", "45").load()
    return got.where((F.col("media_type") == "movie") & (F.col("vote_count") >= 50)).select("tmdb_id", "vote_count", "page")
