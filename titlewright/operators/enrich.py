"""Enriching and screening titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlewright.functions.dims import ANIMATION_GENRE, ANIME_KEYWORD
from titlewright.functions.text import trim_unicode, year_of

VOTE_FLOOR, STUB = 50, 20
_PAIR = "struct<id:bigint,name:string>"
#: Both wire layouts at once: films have title and release_date, series name and first_air_date.
WIRE = (
    f"id bigint, title string, name string, overview string, release_date string, first_air_date string, vote_count bigint, original_language string, genres array<{_PAIR}>, "
    f"origin_country array<string>, production_countries array<struct<iso_3166_1:string>>, keywords struct<keywords:array<{_PAIR}>,results:array<{_PAIR}>>"
)


def is_anime() -> Column:
    """The keyword for it, or Japanese animation. A null language is no match."""
    return F.coalesce(F.array_contains("keyword_ids", ANIME_KEYWORD), F.lit(False)) | (F.coalesce(F.array_contains("genre_ids", ANIMATION_GENRE), F.lit(False)) & F.col("original_language").eqNullSafe("ja"))


def outcome(floor: int = VOTE_FLOOR, stub: int = STUB) -> Column:
    """What becomes of a fetched title: the first of failure, below_floor, anime, no_overview, else ok. A title that wasn't
    found has a null title_id."""
    return (
        F.when(F.col("title_id").isNull(), "failure").when(F.coalesce("vote_count", F.lit(0)) < floor, "below_floor").when(is_anime(), "anime")
        .when(F.char_length(trim_unicode(F.coalesce("overview", F.lit("")))) < stub, "no_overview").otherwise("ok")
    )


def normalize_wire(raw: DataFrame, json: str = "json") -> DataFrame:
    """Rows of a catalogue's JSON, in either layout, as titles. Only nulls fall through to the other field; empty values stay."""
    d = raw.select("*", F.from_json(json, WIRE).alias("w"))
    none = F.array().cast(f"array<{_PAIR}>")
    keywords = F.coalesce("w.keywords.keywords", "w.keywords.results", none)
    genres = F.coalesce("w.genres", none)
    return d.select(
        F.col("w.id").alias("tmdb_id"), F.coalesce("w.title", "w.name", F.lit("")).alias("title"), year_of(F.coalesce("w.release_date", "w.first_air_date")).alias("year"),
        F.coalesce("w.overview", F.lit("")).alias("overview"), F.transform(genres, lambda g: g["id"]).alias("genre_ids"), F.transform(genres, lambda g: g["name"]).alias("genres"),
        F.transform(keywords, lambda k: k["id"]).alias("keyword_ids"), F.transform(keywords, lambda k: k["name"]).alias("keywords"),
        F.coalesce("w.origin_country", F.transform("w.production_countries", lambda c: c["iso_3166_1"]), F.array().cast("array<string>")).alias("origin_country"),
        F.col("w.original_language").alias("original_language"), F.coalesce("w.vote_count", F.lit(0)).alias("vote_count"),
    )


def zip_keywords(ids: str = "keyword_ids", names: str = "keywords") -> Column:
    """Ids with names by position, as many as the shorter has."""
    zipped = F.arrays_zip(F.col(ids).alias("id"), F.col(names).alias("name"))
    return F.slice(zipped, F.lit(1), F.least(F.size(ids), F.size(names)))


def pending(worklist: DataFrame, ledger: DataFrame, key: list[str], seq: str | None = None, limit: int | None = None) -> DataFrame:
    """What the ledger doesn't have yet, the first `limit` by seq."""
    left = worklist.join(ledger.select(*key).distinct(), key, "left_anti")
    return left if limit is None else left.orderBy(seq or key[0], *key).limit(limit)


def enrich(worklist: DataFrame, catalogue: DataFrame, key: list[str], floor: int = VOTE_FLOOR) -> DataFrame:
    """Worklist rows with the catalogue's columns and their outcome."""
    found = catalogue.withColumn("title_id", F.col(key[-1]))
    return worklist.join(found, key, "left").withColumn("outcome", outcome(floor))
