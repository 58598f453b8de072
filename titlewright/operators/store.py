"""Keeping the index: deduplication of an append-only store, its checks and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlewright.functions.text import confidence_bucket

KEY = ["media_type", "tmdb_id"]


def keep_last(store: DataFrame, key: list[str], seq: str) -> DataFrame:
    """Of each key the row with the largest seq. A hash aggregate with partial sums, not a window over a key's whole history."""
    rest = [c for c in store.columns if c not in key]
    return store.groupBy(*key).agg(F.max_by(F.struct(*rest), seq).alias("row")).select(*key, "row.*").select(*store.columns)


def keep_first(store: DataFrame, key: list[str], seq: str) -> DataFrame:
    rest = [c for c in store.columns if c not in key]
    return store.groupBy(*key).agg(F.min_by(F.struct(*rest), seq).alias("row")).select(*key, "row.*").select(*store.columns)


def alignment(labels: DataFrame, vectors: DataFrame, key: list[str]) -> DataFrame:
    """One row: labels, vectors, matched and aligned, which is whether each key has one row on both sides."""
    a = labels.groupBy(*key).agg(F.count("*").alias("a"))
    b = vectors.groupBy(*key).agg(F.count("*").alias("b"))
    both = a.join(b, key, "full_outer")
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return both.agg(n("a").alias("labels"), n("b").alias("vectors"), F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("matched"), F.coalesce(F.bool_and((F.coalesce("a", F.lit(0)) == 1) & (F.coalesce("b", F.lit(0)) == 1)), F.lit(True)).alias("aligned"))


def genre_distribution(records: DataFrame) -> DataFrame:
    return records.groupBy("primary_genre").agg(F.count("*").alias("n"))


def confidence_histogram(records: DataFrame) -> DataFrame:
    """bucket, n over all labels of both axes; a bucket is a tenth, by its lower bound."""
    items = records.select(F.explode(F.concat("subgenres", "moods")).alias("item"))
    return items.groupBy(confidence_bucket(F.col("item.confidence")).alias("bucket")).agg(F.count("*").alias("n"))
