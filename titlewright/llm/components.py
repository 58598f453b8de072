"""Connected components of an edge table by alternating large and small stars, without a collected link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlewright.session import discard, materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, u: str = "a", v: str = "b") -> DataFrame:
    """(node, component) of every node on an edge, component being the smallest node that it reaches.

    Each round writes its edges to the shared folder; the rounds grow with the logarithm of the longest chain. Only
    counts and sums come to the driver. No edges give an empty table. Edges with a null end are left out.
    """
    now = edges.select(F.col(u).cast("bigint").alias("u"), F.col(v).cast("bigint").alias("v")).where("u <> v")
    seen = None
    while True:
        before, now = now, materialize(_large(_small(now)), "edges")
        discard(before)
        is_now = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if seen is not None and tuple(is_now) == seen:
            break
        seen = tuple(is_now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
