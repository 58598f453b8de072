"""The pipeline's stages on a small corpus, each against what it should do to its own input, and the registered SQL."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests_support import compare


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(2)
    v = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    para = lambda n: " ".join(rng.choice(v) for _ in range(n))
    shared, rows, labels = para(15), [], []
    for i in range(400):
        text = para(rng.randint(20, 80)) + "\n" + para(30)
        if i % 8 == 0:
            text = f"{text} vilest{i % 5} {para(3)} vilest{i % 4}"
        if i % 10 == 1:
            text += "\n" + shared
        rows.append((i, text, ["en", "fr"][i % 2], f"src{i % 3}", len(text)))
        labels.append((i, 1, int(i % 8 == 0)))
    rows += [(1000 + i, rows[3][1] + f" tail{i}", "en", "src0", 1) for i in range(5)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "src1", 0), (2002, rows[5][1], "en", "src1", 9), (2002, rows[5][1], "en", "src1", 9)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "lines", "near_duplicates", "mixture", "encoding"]
    clean = stage["toxicity"](spark, docs, sf_dir)
    ids = {r[0] for r in clean.select("doc_id").collect()}
    assert clean.columns == docs.columns and all(i % 8 or i >= 400 for i in ids - {1000, 2000}) and len(ids) == 358
    lines = stage["lines"](spark, clean, sf_dir)
    assert lines.columns == docs.columns and lines.count() == clean.count()
    assert all((r["text"] is None and r["n_chars"] is None) or r["n_chars"] == len(r["text"]) for r in lines.collect())
    near = stage["near_duplicates"](spark, lines, sf_dir)
    # The line that six copies shared is now in 1004 only, which so resembles none of them.
    assert near.columns == docs.columns and {r[0] for r in near.select("doc_id").collect()} == ids - {1000, 1001, 1002, 1003, 2002}
    mixed = stage["mixture"](spark, near, sf_dir)
    assert mixed.columns == docs.columns and 0 < mixed.count() < near.count()
    coded = stage["encoding"](spark, mixed, sf_dir)
    assert coded.count() == mixed.count() and coded.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100


@pytest.mark.parametrize("name", ["op1_mixing", "op2_warc", "op3_substring_dedup", "op4_line_dedup", "op6_sharding", "op8_minhash"])
def test_sql(spark, name):
    from titlewright.llm import queries

    compare(spark, name, queries.queries()[name], queries.oracle_sql()[name])


def test_near_duplicates_keep_texts_that_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (5, b), (5, b + " z"), (7, c), (7, a + " z"), (None, a), (None, a), (8, ""), (9, ""), (8, None), (8, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, component_id string")
    got = corpus_pipeline.near_duplicate_groups(spark, df, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got if r["text"] not in (b, b + " z")) == [(0, a), (0, a), (5, a), (7, c), (8, ""), (8, ""), (9, "")]
    assert [r["doc_id"] for r in got if r["text"] in (b, b + " z")] == [5]
    assert corpus_pipeline.near_duplicate_groups(spark, df.limit(0), "").collect() == []


def test_stages_with_odd_columns_and_rows(spark, sf_dir):
    names = ["own", "own_doc_id", "text_key", "kept", "n_lines", "toxic", "p_toxic", "raw", "topic", "tokens", "p", "selected", "residual", "group_key", "k0", "bitmap", "a.b"]
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = base.where("doc_id < 60 or doc_id >= 1000").unionByName(base.where("doc_id = 7").withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = rows.unionByName(base.where("doc_id = 9").withColumn("text", F.repeat("text", 300)).withColumn("doc_id", F.lit(5000).cast("bigint")))
    odd = rows.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))) for n in names})
    ids = lambda df: sorted(r[0] if r[0] is not None else -1 for r in df.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, sf_dir)
        assert ids(got) == ids(stage(spark, rows, sf_dir)), name
        if name != "encoding":
            assert got.columns == odd.columns, name
            kept = got.collect()
            assert kept and all(r[n] == f"{n}{'?' if r['doc_id'] is None else r['doc_id']}" for r in kept for n in names), name
            assert -1 in ids(got) or name == "mixture", name
        assert stage(spark, odd.limit(0), sf_dir).collect() == [], name
