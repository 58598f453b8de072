"""The registered queries of this subpackage: thin digests over its operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.llm.bpe import bpe
from titlewright.llm import mixing, sharding, sql
from titlewright.llm.lines import line_dedup
from titlewright.llm.minhash import near_duplicates
from titlewright.llm.neighbours import nearest
from titlewright.llm.substrings import substring_dedup
from titlewright.llm.toxicity import Model, fit_chain, score_chain
from titlewright.llm.transport import read_transport, store_transport
from titlewright.llm.warc import read_warc, write_warc
from titlewright.session import materialize, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """met tells whether all marginals are within 1e-9 of their targets."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", mixing.token_count(F.col("text")).alias("tokens"))
    mixed = mixing.mix_sources(materialize(docs.withColumn("topic", mixing.length_band(F.col("tokens"))), "tokens"))
    return mixed.select("doc_id", F.coalesce("source", F.lit("(none)")).alias("source"), F.coalesce("lang", F.lit("(none)")).alias("lang"), "topic", "tokens", F.round("p", 6).alias("p"), "selected", (F.col("residual") <= 1e-9).alias("met"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_warc(_table(spark, sf_dir, "pages"), path)
    back = read_warc(spark, path)
    digest = F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("declared_digest"))
    return back.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"), digest=True)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents"), digest=True)


#: From the general to the particular: unfit is either of the others.
CATEGORIES = ("unfit", "low_quality", "toxic")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model:
    """The chain of the labels table: each category's model sees the probabilities of those before it."""
    low = 1 - F.col("quality")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.greatest(low, "toxic").alias("unfit"), low.alias("low_quality"), "toxic")
    return fit_chain(docs, labels, CATEGORIES)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f1 is the out-of-fold F1 of the last category, the same in all rows."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity_model(spark, sf_dir, docs)
    return score_chain(docs, model).select("doc_id", *[F.round(f"p_{c}", 6).alias(f"p_{c}") for c in CATEGORIES], "toxic", (~F.col("toxic")).alias("kept"), F.lit(round(model.accuracy[-1], 6)).alias("f1"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 16)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).drop("text_key", "group_key")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_transport(store_transport(_table(spark, sf_dir, "documents")), digest=True)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), full=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_mixing, op2_warc, op3_substring_dedup, op4_line_dedup, op5_toxicity, op6_sharding, op7_neighbours, op8_minhash, op9_media_columns, op10_bpe)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
