"""Selecting the universe of ids: a typed filter over a catalogue, and worklists from it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AND, OR = ",", "|"


@dataclass(frozen=True)
class DiscoverSpec:
    media_type: str = "movie"
    genres: tuple[int, ...] = ()
    genre_join: str = AND
    keywords: tuple[int, ...] = ()
    keyword_join: str = OR
    without_genres: tuple[int, ...] = ()
    original_language: str | None = None
    origin_country: tuple[str, ...] = ()
    origin_country_join: str = OR
    vote_count_gte: int | None = None
    release_date_gte: str | None = None
    release_date_lte: str | None = None
    sort_by: str = "popularity.desc"
    include_adult: bool = False

    def params(self) -> dict[str, str]:
        """The request parameters in the order of their names; empty lists and strings are left out."""
        listed = lambda xs, join: join.join(map(str, xs))
        date = "first_air_date" if self.media_type == "tv" else "primary_release_date"
        every = {
            "sort_by": self.sort_by, "include_adult": str(self.include_adult).lower(), "with_genres": listed(self.genres, self.genre_join), "with_keywords": listed(self.keywords, self.keyword_join),
            "without_genres": listed(self.without_genres, AND), "with_original_language": self.original_language, "with_origin_country": listed(self.origin_country, self.origin_country_join),
            "vote_count.gte": None if self.vote_count_gte is None else str(self.vote_count_gte),
        }
        # A date bound is sent even when it is an empty string.
        dates = {f"{date}.gte": self.release_date_gte, f"{date}.lte": self.release_date_lte}
        return dict(sorted({k: v for k, v in every.items() if v}.items() | {k: v for k, v in dates.items() if v is not None}.items()))

    def predicate(self) -> Column:
        """The same filter over a catalogue with genre_ids, keyword_ids, original_language, origin_country, vote_count and release_date."""

        def listed(column: str, values: tuple, join: str, kind: str) -> Column | None:
            if not values:
                return None
            wanted = F.array(*map(F.lit, values)).cast(f"array<{kind}>")
            return F.arrays_overlap(column, wanted) if join == OR else reduce(lambda a, b: a & b, (F.array_contains(column, v) for v in values))

        terms = [listed("genre_ids", self.genres, self.genre_join, "bigint"), listed("keyword_ids", self.keywords, self.keyword_join, "bigint"), listed("origin_country", self.origin_country, self.origin_country_join, "string")]
        terms += [~F.array_contains("genre_ids", g) for g in self.without_genres]
        if self.original_language:
            terms.append(F.col("original_language") == self.original_language)
        if self.vote_count_gte is not None:
            terms.append(F.col("vote_count") >= self.vote_count_gte)
        if self.release_date_gte:
            terms.append(F.col("release_date") >= self.release_date_gte)
        if self.release_date_lte:
            terms.append(F.col("release_date") <= self.release_date_lte)
        return reduce(lambda a, b: a & b, (t for t in terms if t is not None), F.lit(True))


def discover(catalogue: DataFrame, spec: DiscoverSpec) -> DataFrame:
    return catalogue.where((F.col("media_type") == spec.media_type) & F.coalesce(spec.predicate(), F.lit(False)))


def first_seen(entries: DataFrame, key: list[str], seq: str) -> DataFrame:
    """One row for each key with its least seq: a distinct that keeps the order of first sight."""
    return entries.groupBy(*key).agg(F.min(seq).alias(seq))


def worklist_top(catalogue: DataFrame, count: int, floor: int) -> DataFrame:
    """The `count` ids of most votes, ties by id."""
    return catalogue.where(F.col("vote_count") >= floor).orderBy(F.desc("vote_count"), "tmdb_id").limit(count)


def worklist_by_year(catalogue: DataFrame, count: int, floor: int, year_min: int = 1920, year_max: int = 2026) -> DataFrame:
    """Years from the newest on, each by votes, until `count` ids are reached. Every id has one year, so slices of years are an order."""
    some = catalogue.where((F.col("vote_count") >= floor) & F.col("year").between(year_min, year_max))
    return some.orderBy(F.desc("year"), F.desc("vote_count"), "tmdb_id").limit(count)


def worklist_origins(catalogue: DataFrame, origins: list[str], floor: int) -> DataFrame:
    """All ids of each origin in turn, each id once, at the first origin that has it; slice is the origin's position."""
    wanted = F.array(*map(F.lit, origins))
    place = F.array_min(F.transform(F.array_intersect(wanted, "origin_country"), lambda o: F.array_position(wanted, o)))
    out = catalogue.where(F.col("vote_count") >= floor).withColumn("slice", (place - 1).cast("int")).where("slice is not null")
    return out
