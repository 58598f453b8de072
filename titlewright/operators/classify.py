"""Merging repeated noisy votes into a calibrated classification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlewright.functions import dims


@dataclass(frozen=True)
class ClassifierConfig:
    subgenre: float = 0.70
    thematic: float = 0.55
    mood: float = 0.60
    bonus: float = 0.1
    tie_margin: float = 0.25
    top: int = 3


@dataclass(frozen=True)
class EscalationConfig:
    primaries: tuple[str, ...] = ("Drama", "Comedy", "Thriller")
    confidence: float = 0.65


def primary_tally(votes: DataFrame, key: list[str]) -> DataFrame:
    """key, primary_genre, n, top (the largest n) and total of the votes for genres of the vocabulary."""
    # Dealt out by title once: counts, ranks and joins by title keep that partitioning.
    counts = votes.where(F.col("primary_genre").isin(dims.PRIMARY)).repartition(*key).groupBy(*key, "primary_genre").agg(F.count("*").alias("n"))
    own = Window.partitionBy(*key)
    return counts.select("*", F.max("n").over(own).alias("top"), F.sum("n").over(own).alias("total"))


def with_rarity(df: DataFrame, genre: str = "primary_genre") -> DataFrame:
    """The column weight; 1 for a genre without one. The lookup has 18 rows."""
    w = dims.rarity(df.sparkSession).withColumnRenamed("genre", genre)
    return df.join(F.broadcast(w), genre, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def fused_primary(votes: DataFrame, key: list[str], cfg: ClassifierConfig | None = None) -> DataFrame:
    """key, primary_genre: of the genres within the margin of the most voted one the rarest, then the most voted, then by name."""
    cfg = cfg or ClassifierConfig()
    near = with_rarity(primary_tally(votes, key)).where((F.col("top") - F.col("n")) / F.col("total") <= cfg.tie_margin)
    best = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("weight"), F.desc("n"), "primary_genre"))
    return near.withColumn("turn", best).where("turn = 1").select(*key, "primary_genre")


def _fold(items: Column) -> Column:
    """The sum of confidences in the order of pass and position: additions of doubles depend on it."""
    return F.aggregate(F.array_sort(items), F.lit(0.0), lambda a, x: a + x["confidence"])


def label_confidence(votes: DataFrame, items: DataFrame, key: list[str]) -> DataFrame:
    """key, label, confidence: the sum of a label's confidences over the number of the title's votes, with or without it.

    items: key, pass, pos, label, confidence. votes: a row for each vote that could be read. One vote may name a label twice.
    """
    denominators = votes.groupBy(*key).agg(F.count("*").alias("votes"))
    sums = items.repartition(*key).groupBy(*key, "label").agg(_fold(F.collect_list(F.struct("pass", "pos", "confidence"))).alias("sum"))
    return sums.join(denominators, key).select(*key, "label", (F.col("sum") / F.greatest(F.lit(1), F.col("votes")).cast("double")).alias("confidence"))


def in_vocabulary(labels: DataFrame, axis: str, cfg: ClassifierConfig | None = None) -> DataFrame:
    """Labels of the axis only, exact in case, with family and threshold."""
    cfg = cfg or ClassifierConfig()
    vocab = dims.vocabulary(labels.sparkSession, cfg.subgenre, cfg.thematic, cfg.mood).where(F.col("axis") == axis).select("label", "family", "threshold")
    return labels.join(F.broadcast(vocab), "label")


def ground(labels: DataFrame, titles: DataFrame, key: list[str], cfg: ClassifierConfig | None = None) -> DataFrame:
    """The column grounded, whether one of the title's keyword ids stands for the label; then the bonus is added, up to 1."""
    cfg = cfg or ClassifierConfig()
    of = F.broadcast(dims.grounding(labels.sparkSession))
    with_ids = labels.join(of, F.lower("label") == F.col("grounds"), "left").withColumnRenamed("keyword_ids", "grounding_ids").drop("grounds")
    both = with_ids.join(titles.select(*key, "keyword_ids"), key, "left")
    hit = F.coalesce(F.arrays_overlap("keyword_ids", "grounding_ids"), F.lit(False))
    lifted = F.when(hit, F.least(F.lit(1.0), F.col("confidence") + F.lit(cfg.bonus))).otherwise(F.col("confidence"))
    return both.withColumn("grounded", hit).withColumn("confidence", lifted).drop("keyword_ids", "grounding_ids")


def top_labels(labels: DataFrame, key: list[str], cfg: ClassifierConfig | None = None) -> DataFrame:
    """The most confident labels that reach their threshold, ties by name, with their rank."""
    cfg = cfg or ClassifierConfig()
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("confidence"), "label"))
    return labels.where("confidence >= threshold").withColumn("rank", rank).where(F.col("rank") <= cfg.top)


def classify_axis(votes: DataFrame, items: DataFrame, titles: DataFrame, key: list[str], axis: str, cfg: ClassifierConfig | None = None) -> DataFrame:
    """key, rank, label, family, grounded, confidence of the labels that a title gets on one axis. Labels that the vocabulary
    lacks go before anything is summed."""
    known = in_vocabulary(items, axis, cfg).drop("family", "threshold")
    scored = in_vocabulary(label_confidence(votes, known, key), axis, cfg)
    return top_labels(ground(scored, titles, key, cfg), key, cfg)


def _listed(labels: DataFrame, key: list[str], name: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("rank", "label", "confidence")))
    return labels.groupBy(*key).agg(F.transform(ordered, lambda x: F.struct(x["label"].alias("label"), x["confidence"].alias("confidence"))).alias(name))


def index_records(titles: DataFrame, votes: DataFrame, subgenres: DataFrame, moods: DataFrame, key: list[str], cfg: ClassifierConfig | None = None) -> DataFrame:
    """The published row of every title with a primary genre: its labels, source and whether it is animated."""
    none = F.array().cast("array<struct<label:string,confidence:double>>")
    out = titles.join(fused_primary(votes, key, cfg), key)
    for name, items in (("subgenres", subgenres), ("moods", moods)):
        out = out.join(_listed(classify_axis(votes, items, titles, key, name, cfg), key, name), key, "left").withColumn(name, F.coalesce(name, none))
    return out.withColumn("source", F.lit("llm")).withColumn("animated", F.coalesce(F.array_contains("genre_ids", dims.ANIMATION_GENRE), F.lit(False)))


def escalation(titles: DataFrame, first_pass: DataFrame, key: list[str], cfg: EscalationConfig | None = None) -> DataFrame:
    """titles with the column escalate: no vote, no primary genre, a broad one, or subgenres of which none is confident.
    first_pass (key, primary_genre, subgenres) is taken as it is, whatever the vocabulary says; having no subgenre is no doubt."""
    cfg = cfg or EscalationConfig()
    vote = first_pass.select(*key, "primary_genre", "subgenres", F.lit(True).alias("voted"))
    most = F.array_max(F.transform("subgenres", lambda x: x["confidence"]))
    doubt = F.col("voted").isNull() | F.col("primary_genre").isNull() | F.col("primary_genre").isin(*cfg.primaries) | F.coalesce(most < cfg.confidence, F.lit(False))
    return titles.join(vote, key, "left").withColumn("escalate", doubt).drop("voted", "subgenres", "primary_genre")


def missing_votes(titles: DataFrame, votes: DataFrame, key: list[str]) -> DataFrame:
    """Titles that no pass has a vote for; they stay pending."""
    return titles.join(votes.select(*key).distinct(), key, "left_anti")


SYSTEM_PROMPT = (
    "You are a film/TV cataloguer. Assign labels ONLY from the provided controlled vocabulary. Never invent labels. Pick the single dominant primary genre. "
    "Be specific; omit weak guesses (confidence < 0.5). No anime labels. Output only JSON matching the schema."
)  # Fixed value.


def prompt(title: str = "title") -> Column:
    """The user's part of a labelling request for a row with the columns of a title."""
    listed = ", ".join
    # Fixed value: the wording of the request.
    head = f"VOCABULARY:\n  primary_genre: [{listed(dims.PRIMARY)}]\n  subgenres:     [{listed(dims.SUBGENRES + dims.THEMATIC)}]\n  moods:         [{listed(dims.MOODS)}]\n\n"
    tail = '\n\nReturn JSON:\n{ "primary_genre": "<one>",\n  "subgenres": [{"label":"<from list>","confidence":0-1}, ...≤3],\n  "moods":     [{"label":"<from list>","confidence":0-1}, ...≤3] }'
    return F.concat(
        F.lit(head + "TITLE: "), F.col(title), F.lit(" ("), F.coalesce(F.col("year").cast("string"), F.lit("?")), F.lit(") — "), F.col("media_type"), F.lit("\nTMDB_GENRES: "), F.array_join("genres", ", "), F.lit("\nKEYWORDS: "),
        F.array_join("keywords", ", "), F.lit("\nORIGIN: "), F.array_join("origin_country", "/"), F.lit(" / "), F.coalesce("original_language", F.lit("?")), F.lit("\nOVERVIEW: "), F.col("overview"), F.lit(tail),
    )


def requests(titles: DataFrame) -> DataFrame:
    """A labelling request for each title: system and user text, at most 512 tokens, temperature 0."""
    return titles.select("media_type", "tmdb_id", F.lit(SYSTEM_PROMPT).alias("system"), prompt().alias("user"), F.lit(512).alias("max_tokens"), F.lit(0.0).alias("temperature"))
