"""Scalar functions as column expressions; none of them needs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: A letter or number, and what follows as long as it is a letter, a number, a mark or a joiner.
TOKEN = r"[\p{IsAlphabetic}\p{N}][\p{IsAlphabetic}\p{N}\p{M}\x{200D}\x{200C}]*"
# FNV-1a's offset basis in two 32-bit limbs; its prime is 2^40 + 435.
_OFFSET_HI, _OFFSET_LO = 14695981039346656037 >> 32, 14695981039346656037 & 0xFFFFFFFF
_LIMB = 0xFFFFFFFF


def tokenize(text: Column) -> Column:
    """Lower-cased tokens in order; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def fnv1a(token: Column) -> Column:
    """The 64-bit FNV-1a hash of the UTF-8 bytes as a struct of two 32-bit limbs, hi and lo.

    Spark has no unsigned arithmetic and raises on overflow; with limbs every intermediate stays below 2^42.
    """
    chars = F.split(F.decode(F.encode(token, "UTF-8"), "ISO-8859-1"), "")  # a character for each byte
    start = F.struct(F.lit(_OFFSET_HI).cast("bigint").alias("hi"), F.lit(_OFFSET_LO).cast("bigint").alias("lo"))

    def step(state: Column, char: Column) -> Column:
        x = state["lo"].bitwiseXOR(F.ascii(char).cast("bigint"))
        low = x * 435
        hi = (state["hi"] * 435 + F.shiftrightunsigned(low, 32) + F.shiftleft(x, 8)).bitwiseAND(F.lit(_LIMB))
        return F.struct(hi.alias("hi"), low.bitwiseAND(F.lit(_LIMB)).alias("lo"))

    return F.when(token == "", start).otherwise(F.aggregate(chars, start, step))


def bucket(hash_: Column, dim: int) -> Column:
    """The unsigned hash modulo dim."""
    return ((hash_["hi"] % dim) * ((1 << 32) % dim) + hash_["lo"]) % dim


def sign(hash_: Column) -> Column:
    """+1 if bit 33 is clear, else -1."""
    return F.when(F.shiftright(hash_["hi"], 1).bitwiseAND(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")


def quantize(x: Column, scale: float = 127.0) -> Column:
    """x * scale in single precision, rounded half away from zero and clamped to the scale, as a byte."""
    y = (F.lit(scale).cast("float") * x.cast("float")).cast("float").cast("double")
    return F.greatest(F.lit(-scale), F.least(F.lit(scale), F.signum(y) * F.floor(F.abs(y) + 0.5))).cast("tinyint")


def dequantize(q: Column, scale: float = 127.0) -> Column:
    return (q.cast("float") / F.lit(scale).cast("float")).cast("float")


def row_hex(v: Column) -> Column:
    """A vector of bytes as upper-case hex in two's complement."""
    return F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(255))), 2, "0")), "")


def trim_unicode(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def confidence_bucket(c: Column) -> Column:
    low = F.floor(c * 10) / F.lit(10.0)
    return F.format_string("%.1f-%.1f", low, low + F.lit(0.1))


def json_in_prose(text: Column) -> Column:
    """From the first { to the last }; null if there is no such part."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def iso8601(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def rfc1123(ts: Column) -> Column:
    return F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def year_of(date: Column) -> Column:
    """The first four characters as a number; null if they aren't one."""
    return F.substring(date, 1, 4).try_cast("int")


def register_sql(spark: SparkSession) -> None:
    """tw_tokenize, tw_confidence_bucket and tw_json_in_prose as temporary SQL functions."""
    token = TOKEN.replace("\\", "\\\\")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION tw_tokenize(t STRING) RETURNS ARRAY<STRING> RETURN coalesce(regexp_extract_all(lower(t), '{token}', 0), CAST(array() AS ARRAY<STRING>))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tw_confidence_bucket(c DOUBLE) RETURNS STRING RETURN format_string('%.1f-%.1f', floor(c * 10) / 10D, floor(c * 10) / 10D + 0.1D)")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION tw_json_in_prose(t STRING) RETURNS STRING RETURN nullif(regexp_extract(t, '(?s)\\{.*\\}', 0), '')")
