import numpy as np
import pytest
from pyspark.sql import functions as F

from titlewright.functions import dims, text


def fnv(s: str) -> int:
    h = 14695981039346656037
    for b in s.encode():
        h = (h ^ b) * 1099511628211 % (1 << 64)
    return h


TOKENS = ["zebra", "héist", "a", "日本語", "é" * 50, "7up", "\U0001f600", ""]


def test_fnv1a(spark):
    df = spark.createDataFrame([(t,) for t in TOKENS], "t string").withColumn("h", text.fnv1a(F.col("t")))
    for t, hi, lo, b, s in df.select("t", "h.hi", "h.lo", text.bucket(F.col("h"), 384), text.sign(F.col("h"))).collect():
        h = fnv(t)
        assert (hi << 32 | lo) == h and b == h % 384 and s == (1 if h >> 33 & 1 == 0 else -1)
    assert fnv("zebra") == 17805389257797370287


@pytest.mark.parametrize("dim", [1, 2, 7, 256, 384, 1000])
def test_bucket_of_any_dimension(spark, dim):
    df = spark.createDataFrame([(t,) for t in TOKENS], "t string")
    assert [r[0] for r in df.select(text.bucket(text.fnv1a(F.col("t")), dim)).collect()] == [fnv(t) % dim for t in TOKENS]


def test_tokenize(spark):
    df = spark.createDataFrame([("L'Été_noir—½ Ⅳ 7up",), (None,), ("",), ("...",)], "t string")
    assert [r[0] for r in df.select(text.tokenize(F.col("t"))).collect()] == [["l", "été", "noir", "½", "ⅳ", "7up"], [], [], []]


def test_quantize_is_single_precision_and_rounds_half_away(spark):
    xs = [0.0, 1.0, -1.0, 0.5, -0.5, 2.0, -3.0, *np.random.default_rng(1).uniform(-1, 1, 500).tolist()]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(text.quantize(F.col("x"))).collect()]
    y = np.float32(127) * np.array(xs, np.float32)
    want = np.clip(np.sign(y) * np.floor(np.abs(y.astype(float)) + 0.5), -127, 127)
    assert got == want.astype(int).tolist()


def test_row_hex_and_dequantize(spark):
    row = spark.createDataFrame([([127, -127, 0, 42],)], "v array<tinyint>").select(text.row_hex(F.col("v")), F.transform("v", lambda q: text.dequantize(q))).first()
    assert row[0] == "7F81002A" and row[1][0] == 1.0


def test_small_functions(spark):
    row = spark.createDataFrame([("　 x  ", "no {a {b} c} d", 0.7999999999999999, "19x", "2001-02-03")], "t string, p string, c double, bad string, d string")
    got = row.select(text.trim_unicode(F.col("t")), text.json_in_prose(F.col("p")), text.confidence_bucket(F.col("c")), text.year_of(F.col("bad")), text.year_of(F.col("d"))).first()
    assert tuple(got) == ("x", "{a {b} c}", "0.7-0.8", None, 2001)


def test_sql_functions(spark):
    text.register_sql(spark)
    row = spark.sql("SELECT tw_tokenize('A b-c'), tw_confidence_bucket(0.85D), tw_json_in_prose('x {1} y')").first()
    assert tuple(row) == (["a", "b", "c"], "0.8-0.9", "{1}")


def test_vocabulary_sizes(spark):
    assert [len(x) for x in (dims.PRIMARY, dims.SUBGENRES, dims.THEMATIC, dims.REGIONAL, dims.MOODS)] == [18, 19, 29, 13, 14]
    assert dims.vocabulary(spark).count() == 93 and dims.genre_names(spark).count() == 35 and len(dims.GROUNDING) == 18
    assert set(dims.RARITY) == set(dims.PRIMARY)
