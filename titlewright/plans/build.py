"""The dataset build, step by step: worklist, enrich, escalate, assemble, finalize, score. Each step reads and writes files
below one folder, and can be run again."""

from __future__ import annotations

import json
import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.functions import dims
from titlewright.session import materialize
from titlewright.operators import classify, discover, embed, enrich, score, store, votes
from titlewright.sources import readers, sinks, storage
from titlewright.streaming.ledger import Ledger

KEY = store.KEY


class StepError(Exception):
    """A step can't be done with the given inputs."""


class Layout:
    """Where everything lies below an output folder."""

    def __init__(self, out_dir: str):
        at = lambda name: os.path.join(out_dir, name)
        self.enrich_ledger, self.classify_ledger, self.store = at("ledger/enrich"), at("ledger/classify"), at("index")
        self.enriched = lambda n: at(f"enriched/batch-{n}.json")
        self.escalate = lambda n: at(f"escalate/batch-{n}.json")
        self.votes = lambda n, p="*": at(f"votes/batch-{n}-pass{p}.json")
        self.labels, self.vectors = at(f"labels-{dims.VERSION}.json"), at(f"vectors-{sinks.EMBEDDING}.bin")
        self.meta, self.report, self.log = at("dataset.meta.json"), at("report.json"), at("enrich-log.txt")


_TITLE = ["tmdb_id", "media_type", "title", "year", "overview", "genre_ids", "genres", "keyword_ids", "keywords", "origin_country", "original_language", "vote_count"]


def _write_titles(df: DataFrame, path: str) -> int:
    """One list of titles by id; a batch is a few hundred rows."""
    return sinks.write_list(readers.camel(df.select(*_TITLE)).orderBy("tmdbId", "mediaType"), path)


def _log(lines: DataFrame, path: str) -> None:
    """Adds lines (a column of text) to the log, a folder of text files."""
    if not lines.isEmpty():
        lines.coalesce(1).write.mode("append").text(path)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue: Parquet of titles, or lines of its JSON in either layout with media_type beside it."""
    if path.endswith((".json", ".jsonl")):
        raw = spark.read.text(path).withColumnRenamed("value", "json")
        media = raw.select("json", F.coalesce(F.get_json_object("json", "$.media_type"), F.lit("movie")).alias("media_type"))
        return enrich.normalize_wire(media.select("json", "media_type")).join(media.select(F.get_json_object("json", "$.id").cast("bigint").alias("tmdb_id"), "media_type"), "tmdb_id")
    return spark.read.parquet(path)


def worklist(spark: SparkSession, source: str, out: str, mode: str = "discover", media: str = "movie", count: int = 500, floor: int = 50, origins: tuple[str, ...] = (), years: tuple[int, int] = (1920, 2026)) -> int:
    """Ids from an export of lines or from a catalogue. With origins all ids of each origin; else the `count` of most votes, beyond
    10,000 from the newest year on."""
    if mode == "export":
        got = readers.export_ids(spark, source, media).select("tmdb_id", "media_type")
    else:
        titles = discover.discover(catalogue(spark, source), discover.DiscoverSpec(media))
        if origins:
            got = discover.worklist_origins(titles, list(origins), floor).orderBy("slice", F.desc("vote_count"), "tmdb_id")
        elif count <= 10_000:
            got = discover.worklist_top(titles, count, floor)
        else:
            got = discover.worklist_by_year(titles, count, floor, *years)
    return sinks.write_list(readers.camel(got.select("tmdb_id", "media_type")), out)


def enrich_batch(spark: SparkSession, work: str, source: str, out_dir: str, floor: int = enrich.VOTE_FLOOR, limit: int = 150) -> dict:
    """The next `limit` ids that the ledger lacks, with their catalogue rows; what passes becomes a batch, everything is entered."""
    at = Layout(out_dir)
    ledger = Ledger(spark, at.enrich_ledger)
    todo = readers.worklist(spark, work).withColumn("seq", F.monotonically_increasing_id())
    seen = discover.first_seen(todo, KEY, "seq")
    left = enrich.pending(seen, ledger.read(), KEY)
    remaining = left.count()
    if not remaining:
        return {"remaining": 0, "count": 0}
    batch = ledger.next_batch()
    picked = left.orderBy("seq").limit(limit)
    got = enrich.enrich(picked, catalogue(spark, source), KEY, floor)
    entered = ledger.append(got.select(*KEY, "outcome"), batch)
    ok = got.join(entered.where("outcome = 'ok'").select(*KEY), KEY, "left_semi")
    count = _write_titles(ok, at.enriched(batch))
    totals = {r[0]: r[1] for r in entered.groupBy("outcome").count().collect()}
    _log(entered.where("outcome = 'failure'").select(F.format_string("fetch-failure id=%d", "tmdb_id")), at.log)
    n = lambda k: totals.get(k, 0)
    return {"batchId": batch, "count": count, "belowFloor": n("below_floor"), "anime": n("anime"), "noOverview": n("no_overview"), "failures": n("failure"), "remaining": remaining - sum(totals.values()), "batch": at.enriched(batch)}


def enrich_ids(spark: SparkSession, ids: str, source: str, out_dir: str, batch: int, media: str = "movie") -> dict:
    """A batch of the ids of a vote file, without ledger or filters; those that the catalogue lacks are left out."""
    at = Layout(out_dir)
    wanted = _votes(spark, ids).where("tmdb_id is not null").select("tmdb_id")
    found = wanted.join(catalogue(spark, source).where(F.col("media_type") == media), "tmdb_id")
    count = _write_titles(found, at.enriched(batch))
    return {"batchId": batch, "requested": wanted.count(), "enriched": count}


def _passes(spark: SparkSession, at: Layout, batch: int, one: str = "*") -> DataFrame:
    return _votes(spark, at.votes(batch, one))


def _votes(spark: SparkSession, pattern: str) -> DataFrame:
    """The votes of files: of those with a line for each read in parallel, of others whole."""
    lines, own, rest = readers.list_lines(spark, pattern)
    by_line = votes.decode_lines(lines)
    if not rest:
        return by_line
    whole = votes.decode_passes(readers.vote_files(spark, rest)).withColumn("pos", F.col("pos").cast("bigint"))
    return by_line.unionByName(whole) if own else whole


def escalation(spark: SparkSession, out_dir: str, batch: int) -> dict:
    """The batch's titles that need more passes. Without a first pass all do."""
    at = Layout(out_dir)
    titles = readers.titles(spark, at.enriched(batch))
    if storage.exists(spark, at.votes(batch, "1")):
        first = votes.first_votes(_passes(spark, at, batch, "1"))
    else:
        first = spark.createDataFrame([], f"tmdb_id bigint, primary_genre string, subgenres {readers.LABELS}")
    marked = classify.escalation(titles, first, ["tmdb_id"])
    count = _write_titles(marked.where("escalate"), at.escalate(batch))
    return {"batchId": batch, "escalate": count, "total": titles.count(), "file": at.escalate(batch)}


def assemble(spark: SparkSession, out_dir: str, batch: int, force: bool = False, cfg: classify.ClassifierConfig | None = None, embedder: embed.Embedder | None = None) -> dict:
    """A batch and its passes: records with their vectors, appended to the store in one table, and the ledger's entries. Titles
    without a vote stay pending, those without a primary genre are done."""
    at = Layout(out_dir)
    titles = readers.titles(spark, at.enriched(batch)).withColumn("seq", F.monotonically_increasing_id())
    passes = _passes(spark, at, batch)
    _log(passes.where("not valid").select(F.format_string("bad-vote-pass %s (unparseable, skipped)", "file")).distinct(), at.log)
    ballots = votes.first_votes(passes)
    if ballots.isEmpty():
        raise StepError(f"no vote passes for batch {batch}")
    ledger = Ledger(spark, at.classify_ledger)
    todo = titles if force else enrich.pending(titles, ledger.read(), KEY)
    # Votes know ids only: a film and a series of one id both have them, each with its own keywords.
    of = materialize(ballots.join(todo.select(*KEY), "tmdb_id"), "ballots")
    records = classify.index_records(todo, of, votes.items(of, "subgenres"), votes.items(of, "moods"), KEY, cfg)
    named = records.withColumn("text", embed.embedding_text())
    vectors = (embedder or embed.HashingEmbedder()).transform(named, KEY, "text")
    rows = vectors.select("media_type", "tmdb_id", "primary_genre", "subgenres", "moods", "source", "animated", "v", "seq")
    done = ledger.next_batch()
    store_batch = f"{at.store}/batch_id={done:09d}"
    rows.write.mode("overwrite").parquet(store_batch)
    written = spark.read.parquet(store_batch).select(*KEY, F.lit("ok").alias("outcome"))
    voted = of.select(*KEY).distinct()
    no_primary = voted.join(written, KEY, "left_anti").withColumn("outcome", F.lit("no_primary"))
    entered = ledger.append(written.unionByName(no_primary), done)
    missing = classify.missing_votes(todo, of, KEY).count()
    return {"batchId": batch, "classifiedTotal": ledger.read().select(*KEY).distinct().count(), "noPrimary": entered.where("outcome = 'no_primary'").count(), "missingVotes": missing}


def read_store(spark: SparkSession, out_dir: str) -> DataFrame:
    """The store's newest row of each title, in the order in which they came."""
    rows = spark.read.option("basePath", Layout(out_dir).store).parquet(Layout(out_dir).store)
    return store.keep_last(rows.withColumn("seq", F.struct("batch_id", "seq")), KEY, "seq")


def finalize(spark: SparkSession, out_dir: str, built: datetime | None = None) -> dict:
    """The published files from the store; the manifest is returned."""
    at = Layout(out_dir)
    # Put in order once; checks, files and report all read it.
    records = materialize(read_store(spark, out_dir).orderBy("seq"), "store").orderBy("seq")
    checks = records.agg(F.count("*"), F.max(F.size("v")), F.min(F.size("v"))).first()
    count, dim = checks[0], checks[1] or 0
    if count and checks[1] != checks[2]:
        raise StepError("the store holds vectors of different lengths")
    labels = (at.labels, *sinks.write_labels(records, at.labels, dims.VERSION, count))
    vectors = (at.vectors, *sinks.write_vectors(records, at.vectors, count, dim))
    storage.gzip_copy(spark, at.labels)
    meta = sinks.manifest(labels, vectors, count, dim, dims.VERSION, built)
    sinks.write_json(spark, meta, at.meta)
    outcomes = {}
    for name in (at.enrich_ledger, at.classify_ledger):
        outcomes |= {r[0]: r[1] for r in Ledger(spark, name).read().groupBy("outcome").count().collect() if r[0] != "ok"}
    n = lambda k: outcomes.get(k, 0)
    report = {
        "processed": count, "skippedBelowVoteFloor": n("below_floor"), "fetchFailures": n("failure"), "llmCalls": 0, "byPrimaryGenre": dict(map(tuple, store.genre_distribution(records).collect())),
        "confidenceHistogram": dict(map(tuple, store.confidence_histogram(records).collect())),
    }
    sinks.write_json(spark, {"anime": n("anime"), "noPrimary": n("no_primary"), "noOverview": n("no_overview"), "report": report}, at.report)
    return meta


def publish(spark: SparkSession, out_dir: str, to: str) -> dict:
    """The four published files, if they are all there and are what the manifest says, copied to the folder of the current release;
    gives their names and sizes. The manifest comes last, so that a reader of it finds the others."""
    at = Layout(out_dir)
    files = [at.labels, at.labels + ".gz", at.vectors, at.meta]
    if lacking := [os.path.basename(f) for f in files if not storage.exists(spark, f)]:
        raise StepError(f"nothing to publish: no {', '.join(lacking)}")
    meta = json.loads(storage.read_text(spark, at.meta))
    for kind, file in (("labels", at.labels), ("vectors", at.vectors)):
        if (storage.size(spark, file), storage.sha256(spark, file)) != (meta[f"{kind}Bytes"], meta[f"{kind}Sha256"]):
            raise StepError(f"{os.path.basename(file)} isn't what the manifest says")
    if meta["datasetVersion"] != sinks.dataset_version(meta["labelsSha256"], meta["vectorsSha256"]):
        raise StepError("the manifest's version isn't that of its files")
    for file in files:
        storage.copy(spark, file, os.path.join(to, os.path.basename(file)))
    return {os.path.basename(f): storage.size(spark, f) for f in files}


def score_labels(spark: SparkSession, labels: str, golden: str) -> dict:
    """Scores of a labels file against a golden file, and whether the gate failed."""
    gold, rows = readers.golden(spark, golden), readers.records(spark, labels)
    seq = F.monotonically_increasing_id()
    predicted = store.keep_first(rows.withColumn("seq", seq), KEY, "seq")
    total = gold.count()
    covered = store.keep_first(score.covered(gold, predicted, KEY).withColumn("seq", seq), KEY, "seq")
    names = F.transform(F.concat("subgenres", "moods"), lambda x: x["label"])
    of = predicted.join(covered.select(*KEY), KEY, "left_semi")
    per = score.per_label(covered.select(*KEY, F.explode("labels").alias("label")), of.select(*KEY, F.explode(names).alias("label")), KEY).cache()
    primary = score.primary_accuracy(covered, predicted, KEY).first()
    if not primary["titles"]:
        raise StepError("no golden titles present: nothing to score")
    f1 = score.overall_f1(per).first()
    families = {r["family"]: r.asDict() for r in score.per_family(per).collect()}
    per.unpersist()
    failed = any(f["miss"] for f in families.values()) or primary["accuracy"] < score.PRIMARY_TARGET
    return {"covered": covered.count(), "total": total, "accuracy": primary["accuracy"], "micro": f1["micro_f1"], "macro": f1["macro_f1"], "families": families, "failed": failed}
