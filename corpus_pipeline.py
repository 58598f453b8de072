"""A training corpus from documents: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.llm.bpe import bpe
from titlewright.llm.lines import line_dedup
from titlewright.llm.minhash import near_duplicates
from titlewright.llm.mixing import length_band, mix_sources, token_count
from titlewright.llm.queries import toxicity_model
from titlewright.llm.toxicity import score_chain
from titlewright.session import discard, materialize

#: The first stage's decisions come from fitted models, which SQL can't express.
ORACLE_SQL = None


def _own(docs: DataFrame, *without: str) -> Column:
    """The other columns of documents as one, so that none of their names can clash with an operator's."""
    return F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(c) for c in docs.columns if c not in without]).alias("own")


def _restored(df: DataFrame, docs: DataFrame, *beside: str) -> DataFrame:
    return df.select(*[F.col(c) if c in beside else F.col(f"own.`{c}`").alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain doesn't find toxic. Null and empty texts have no words and stay if the rest of a model says so, null
    ids and repeated rows are judged by their text, texts count whole, and no documents give none."""
    own = docs.select("doc_id", "text", _own(docs, "text"))
    scored = score_chain(own, toxicity_model(spark, sf_dir, docs.select("doc_id", "text")), keep=("own", "text"))
    return _restored(scored.where(~F.col("toxic")), docs, "text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows. A document that loses all lines stays, with no text. Null texts
    stay null, null ids lose nothing, repeated rows are one document's, and no documents give none."""
    out = line_dedup(docs.select("doc_id", "text", _own(docs, "text", "n_chars")), carry=("own",)).select("own", F.col("kept").alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return _restored(out, docs, "text", "n_chars")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the least id. Rows that repeat an id and its text become one row. Different texts
    of one id are documents of their own: both stay, but for one of them if they are of one group. Null ids all stay, as do null
    and empty texts, one of each id. No documents give none."""
    own = F.struct("doc_id", "text_key")
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept and doc_id is not null").groupBy("group_key", F.when(F.col("group_key").isNull(), own).alias("alone"))
    kept = kept.agg(F.min(own).alias("first")).select("first.doc_id", "first.text_key")
    packed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("binary")).alias("text_key"), "text", _own(docs, "text"))
    single = packed.join(kept, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return _restored(single.unionByName(packed.where("doc_id is null")), docs, "text")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target weights of source, language and band of length. Documents without words follow their
    cell, null ids are drawn alike, rows that share an id and a cell are drawn together, and no documents give none."""
    own = docs.select(_own(docs), "doc_id", "source", "lang", token_count(F.col("text")).alias("tokens"))
    mixed = mix_sources(own.withColumn("topic", length_band(F.col("tokens"))))
    return _restored(mixed.where("selected"), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens and the digests of its ids and of what they decode to. Null and empty texts have no tokens,
    null ids and repeated rows stay, and no documents give none."""
    import public_tokenizers

    return bpe(docs, public_tokenizers.path("byte_bpe_50k.json"), full=False)


STAGES = [("toxicity", toxicity), ("lines", lines), ("near_duplicates", near_duplicate_groups), ("mixture", mixture), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
