"""Decoding votes and putting passes in order."""

from __future__ import annotations

from abc import ABC, abstractmethod
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlewright.functions.text import json_in_prose
from titlewright.operators import classify
from titlewright.operators.store import KEY
from titlewright.session import materialize

DEFAULT_CONFIDENCE = 0.7
_NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
_LABELS = "array<struct<label:string,confidence:double>>"


def _labels(field: str, alias: str) -> Column:
    """A list of strings or objects as labels with confidences. Missing and non-numeric confidences get the default; nulls of
    the list or missing lists are empty."""
    return F.expr(
        f"""transform(coalesce(try_cast(try_variant_get(v, '$.{field}', 'variant') AS ARRAY<VARIANT>), CAST(array() AS ARRAY<VARIANT>)), e -> named_struct(
        'label', CASE WHEN schema_of_variant(e) = 'STRING' THEN CAST(e AS STRING) WHEN schema_of_variant(variant_get(e, '$.label')) = 'STRING' THEN try_variant_get(e, '$.label', 'string') END,
        'confidence', CASE WHEN schema_of_variant(e) = 'STRING' THEN {DEFAULT_CONFIDENCE}D
            WHEN schema_of_variant(try_variant_get(e, '$.confidence', 'variant')) RLIKE '{_NUMBER}' THEN try_variant_get(e, '$.confidence', 'double') ELSE {DEFAULT_CONFIDENCE}D END))"""
    ).alias(alias)


def decode_passes(raw: DataFrame, file: str = "file", json: str = "json") -> DataFrame:
    """file, pos, tmdb_id, primary_genre, subgenres, moods and valid for each vote of each file, whose json is one list of votes.

    A vote without an id or a label object without a label makes its whole file invalid, as does a list that can't be parsed:
    valid is false on all rows of that file (on one row with a null pos if there are none).
    """
    parsed = raw.select(file, F.expr(f"try_cast(try_parse_json({json}) AS ARRAY<VARIANT>)").alias("list"))
    votes = parsed.select(file, F.col("list").isNotNull().alias("whole"), F.posexplode_outer("list").alias("pos", "v"))
    rows, good = _decoded(votes, file)
    return rows.withColumn("valid", F.col("whole") & F.min(good).over(Window.partitionBy(file))).drop("whole")


def decode_lines(lines: DataFrame, file: str = "file") -> DataFrame:
    """The same for files that are read a vote at a time: file, pos and json of each, of files whose every vote can be parsed."""
    rows, good = _decoded(lines.select(file, F.lit(True).alias("whole"), "pos", F.try_parse_json("json").alias("v")), file)
    bad = F.broadcast(rows.where(~good).select(file).distinct().withColumn("valid", F.lit(False)))  # files, not votes
    return rows.drop("whole").join(bad, file, "left").withColumn("valid", F.coalesce("valid", F.lit(True)))


def _decoded(votes: DataFrame, file: str) -> tuple[DataFrame, Column]:
    """The fields of each vote (v), and whether it has what a vote needs."""
    rows = votes.select(file, "whole", "pos", F.expr("try_variant_get(v, '$.tmdbId', 'bigint')").alias("tmdb_id"), F.expr("try_variant_get(v, '$.primary_genre', 'string')").alias("primary_genre"), _labels("subgenres", "subgenres"), _labels("moods", "moods"))
    good = F.col("pos").isNull() | (F.col("tmdb_id").isNotNull() & ~F.exists("subgenres", lambda x: x["label"].isNull()) & ~F.exists("moods", lambda x: x["label"].isNull()))
    return rows, good


def first_votes(decoded: DataFrame, file: str = "file") -> DataFrame:
    """Of valid files, the first vote of each title, with the file's ordinal by name as pass."""
    ok = decoded.where("valid and pos is not null")
    order = ok.select(file).distinct().withColumn("pass", F.row_number().over(Window.orderBy(file)))  # over files, not votes
    firsts = ok.withColumn("turn", F.row_number().over(Window.partitionBy(file, "tmdb_id").orderBy("pos"))).where("turn = 1").drop("turn", "valid", "pos")
    return firsts.join(F.broadcast(order), file).drop(file)


def parse_strict(text: Column) -> Column:
    """One vote from prose: primary_genre, subgenres, moods. Null unless every label has a string label and a number as
    confidence; lists that are missing or null are empty."""
    json = json_in_prose(text)
    raw = F.from_json(json, f"primary_genre string, subgenres {_LABELS}, moods {_LABELS}")
    v = F.try_parse_json(json)

    def whole(name: str) -> Column:
        given = F.try_variant_get(v, f"$.{name}", "variant")
        kind = F.schema_of_variant(given)
        bad = F.exists(raw[name], lambda x: x.isNull() | x["label"].isNull() | x["confidence"].isNull())
        return given.isNull() | (kind == "VOID") | (raw[name].isNotNull() & ~F.coalesce(bad, F.lit(False)))

    sound = v.isNotNull()
    none = F.array().cast(_LABELS)
    vote = F.struct(raw["primary_genre"].alias("primary_genre"), F.coalesce(raw["subgenres"], none).alias("subgenres"), F.coalesce(raw["moods"], none).alias("moods"))
    return F.when(sound & whole("subgenres") & whole("moods"), vote)


class VoteSource(ABC):
    """Whoever answers labelling requests, such as a model behind mapInArrow or a table of answers."""

    @abstractmethod
    def answers(self, requests: DataFrame, sample: int) -> DataFrame:
        """media_type, tmdb_id and raw (prose with one vote as JSON) for requests (media_type, tmdb_id, system, user, max_tokens,
        temperature). sample counts from 1: the same requests are put once for each."""


class NoVotes(VoteSource):
    """The default: votes come from files, nobody is asked."""

    def answers(self, requests: DataFrame, sample: int) -> DataFrame:
        raise NotImplementedError("no source of votes is set up")


def ask(titles: DataFrame, source: VoteSource, samples: int = 3) -> DataFrame:
    """media_type, tmdb_id, pass, primary_genre, subgenres, moods of the answers that parse, `samples` (at least one) for each title."""
    wanted = classify.requests(titles)
    each = [source.answers(wanted, n).select(*KEY, F.lit(n).alias("pass"), parse_strict(F.col("raw")).alias("vote")) for n in range(1, max(1, samples) + 1)]
    return reduce(DataFrame.unionByName, each).where("vote is not null").select(*KEY, "pass", "vote.*")


def items(ballots: DataFrame, axis: str, key: list[str] = KEY) -> DataFrame:
    """key, pass, pos, label, confidence of the labels on one axis."""
    return ballots.select(*key, "pass", F.posexplode(axis).alias("pos", "l")).select(*key, "pass", "pos", "l.label", "l.confidence")


def classify_titles(titles: DataFrame, source: VoteSource, samples: int = 3, cfg: classify.ClassifierConfig | None = None) -> DataFrame:
    """The records of titles by the answers of a source."""
    ballots = materialize(ask(titles, source, samples), "ballots")  # nobody is asked twice
    return classify.index_records(titles, ballots, items(ballots, "subgenres"), items(ballots, "moods"), KEY, cfg)
