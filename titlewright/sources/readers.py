"""Reading the engine's files."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = "array<struct<label:string,confidence:double>>"
TITLE = "tmdbId bigint, mediaType string, title string, year int, overview string, genreIDs array<bigint>, genres array<string>, keywordIDs array<bigint>, keywords array<string>, originCountry array<string>, originalLanguage string, voteCount bigint"
RECORD = f"tmdbId bigint, mediaType string, primaryGenre string, subgenres {LABELS}, moods {LABELS}, source string, animated boolean"
GOLDEN = "taxonomyVersion string, titles array<struct<tmdbId:bigint,mediaType:string,title:string,year:int,primaryGenre:string,subgenres:array<string>,themes:array<string>,moods:array<string>>>"
_SNAKE = {"tmdbId": "tmdb_id", "mediaType": "media_type", "primaryGenre": "primary_genre", "genreIDs": "genre_ids", "keywordIDs": "keyword_ids", "originCountry": "origin_country", "originalLanguage": "original_language", "voteCount": "vote_count"}


def snake(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in _SNAKE.items() if k in df.columns})


def camel(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in _SNAKE.items() if v in df.columns})


def export_ids(spark: SparkSession, path: str, media_type: str) -> DataFrame:
    """tmdb_id, media_type of each line with an integer id; other lines are passed over. The order is that of the lines."""
    lines = spark.read.text(path)
    return parse_export(lines, "value", media_type)


def parse_export(lines: DataFrame, column: str, media_type: str) -> DataFrame:
    """The id of each line of JSON; only whole numbers count."""
    v = F.try_parse_json(F.trim(column))
    kind = F.schema_of_variant(F.try_variant_get(v, "$.id", "variant"))
    got = lines.withColumn("tmdb_id", F.when(kind == "BIGINT", F.try_variant_get(v, "$.id", "bigint"))).where("tmdb_id is not null")
    return got.withColumn("media_type", F.lit(media_type))


def list_lines(spark: SparkSession, pattern: str, head: str = r"\[", tail: str = r"\]") -> tuple[DataFrame, list[str], list[str]]:
    """Lists of JSON with a line for each item, as write_list lays them out, so that a file is read in parallel: file (its name),
    pos (in order within a file) and json of each item. Then the paths of the files laid out so, which is checked on every line,
    and those of all others. head and tail: what the first and the last line look like."""
    path = F.col("_metadata.file_path").alias("path")
    lines = spark.read.text(pattern).select(path, F.monotonically_increasing_id().alias("pos"), F.rtrim("value").alias("line"))
    comma, item = F.endswith("line", F.lit(",")), F.startswith("line", F.lit("{"))
    json = F.when(comma, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    first, last = F.rlike("line", F.lit(f"^{head}$")), F.rlike("line", F.lit(f"^{tail}$"))
    sound = item & ~first & F.try_parse_json(json).isNotNull()
    kind = F.when(sound & comma, "more").when(sound, "last").when(first, "head").when(last, "tail").otherwise("other")
    marks = lines.where("line <> ''").select("path", "pos", kind.alias("kind"))
    n = lambda k: F.count_if(F.col("kind") == k).alias(k)
    per = marks.groupBy("path").agg(
        *map(n, ("more", "last", "head", "tail", "other")), F.min_by("kind", "pos").alias("first"), F.max_by("kind", "pos").alias("end"),
        F.max(F.when(F.col("kind") == "more", F.col("pos"))).alias("before"), F.max(F.when(F.col("kind") == "last", F.col("pos"))).alias("at"),
    )
    well = (F.col("first") == "head") & (F.col("end") == "tail") & (F.col("head") == 1) & (F.col("tail") == 1) & (F.col("other") == 0)
    well &= ((F.col("last") == 1) & (F.coalesce("before", F.lit(-1)) < F.col("at"))) | ((F.col("last") == 0) & (F.col("more") == 0))
    plain = lambda p: unquote(p).replace("file:///", "file:/", 1)
    found = {plain(r[0]): r[1] for r in per.select("path", well).collect()}  # a row for each file
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    files = [f.getPath().toString() for f in _listed(spark, pattern)]
    good = [f for f in files if found.get(f.replace("file:///", "file:/", 1))]
    if not good:
        return spark.createDataFrame([], "file string, pos bigint, json string"), [], files
    items = spark.read.text(good).select(path, F.monotonically_increasing_id().alias("pos"), F.rtrim("value").alias("line")).where(item & ~first)
    return items.select(name, "pos", json.alias("json")), good, [f for f in files if f not in good]


def _listed(spark: SparkSession, pattern: str) -> list:
    """The files of a path or pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f for top in system.globStatus(target) or [] for f in (system.listStatus(top.getPath()) if top.isDirectory() else [top]) if not f.getPath().getName().startswith(("_", "."))]


def _items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of lists of JSON; lists of another layout than write_list's are parsed whole."""
    lines, own, rest = list_lines(spark, path)
    rows = lines.select(F.from_json("json", schema).alias("r")).select("r.*")
    if own and not rest:
        return rows
    whole = spark.read.schema(schema).option("multiLine", True).json(rest or path)
    return rows.unionByName(whole) if own else whole


def titles(spark: SparkSession, path: str) -> DataFrame:
    """An enriched batch (a list of titles); keyword ids and names are cut to the shorter of the two."""
    raw = snake(_items(spark, path, TITLE))
    n = F.least(F.size("keyword_ids"), F.size("keywords"))
    return raw.withColumn("keyword_ids", F.slice("keyword_ids", F.lit(1), n)).withColumn("keywords", F.slice("keywords", F.lit(1), n))


def worklist(spark: SparkSession, path: str) -> DataFrame:
    return snake(_items(spark, path, "tmdbId bigint, mediaType string"))


def vote_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file (its name) and json of each file that matches."""
    return spark.read.text(paths, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("json"))


_SPLIT = '},{"animated":'


def records(spark: SparkSession, path: str) -> DataFrame:
    """Index records: lines of a store, or the list inside an artifact. An artifact with its keys in order and without white space,
    as finalize writes it, is one long line: it is split where a record begins (quotes inside a string are escaped, so it can be
    nowhere else) and read in parallel; any other is parsed whole."""
    if path.endswith(".jsonl"):
        return snake(spark.read.schema(RECORD).json(path))
    pieces = spark.read.option("lineSep", _SPLIT).text(path)
    first = pieces.first()
    if first and re.match(r'\{"count":\d+,"records":\[\{"animated":', first[0]):
        body = F.regexp_replace(F.regexp_replace("value", r'^\{"count":\d+,"records":\[\{"animated":', ""), r'\}\],"taxonomyVersion":"[^"]*"\}\s*$', "")
        return snake(pieces.select(F.from_json(F.concat(F.lit('{"animated":'), body, F.lit("}")), RECORD).alias("r")).select("r.*"))
    whole = spark.read.schema(f"taxonomyVersion string, count bigint, records array<struct<{', '.join(':'.join(f.split(' ', 1)) for f in RECORD.split(', '))}>>").option("multiLine", True).json(path)
    return snake(whole.select(F.explode("records").alias("r")).select("r.*"))


def golden(spark: SparkSession, path: str) -> DataFrame:
    """The golden titles; labels are subgenres, themes and moods together."""
    lines, own, rest = list_lines(spark, path, r'\{"taxonomyVersion":"[^"]*","titles":\[', r"\]\}")
    if own and not rest:
        kind = next(f.dataType.elementType for f in T._parse_datatype_string(GOLDEN) if f.name == "titles")
        rows = snake(lines.select(F.from_json("json", kind).alias("t")).select("t.*"))
    else:
        whole = spark.read.schema(GOLDEN).option("multiLine", True).json(path)
        rows = snake(whole.select(F.explode("titles").alias("t")).select("t.*"))
    none = F.array().cast("array<string>")
    return rows.withColumn("labels", F.array_union(F.array_union(F.coalesce("subgenres", none), F.coalesce("themes", none)), F.coalesce("moods", none)))
