"""Sharding by sampled splitters: near-equal bytes for each shard, in the order of a content key.

Records are ordered by (key of the text, doc_id), so equal texts are neighbours and no single key is indivisible. A
size-weighted sample of that order gives quantile boundaries of many ranges; ranges that turn out overfull are sampled again
and subdivided. Each range is then ordered by itself, and the ranges' totals place every record at its exact byte of the whole
order, which is cut into shards of equal bytes. All of it is DataFrame operations over (doc_id, size, check sum, key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlewright.session import discard, materialize

_LEAST = -(1 << 63)
_SAMPLES = 64  # of a range
_MOST_RANGES = 4096


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, plus 1), text_crc32 and key (60 bits of the text's MD5) for each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    key = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("key"))


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """The number of splitters at or below a record, by binary search."""
    if not splitters:
        return F.lit(0)
    keys, ids = F.lit([k for k, _ in splitters]).cast("array<bigint>"), F.lit([i for _, i in splitters]).cast("array<bigint>")
    steps = F.lit([1 << k for k in reversed(range(len(splitters).bit_length()))])

    def step(at: Column, by: Column) -> Column:
        to = at + by
        k, i = F.get(keys, to - 1), F.get(ids, to - 1)  # null beyond the end
        return F.when((k < F.col("key")) | (k == F.col("key")) & (i <= F.coalesce("doc_id", F.lit(_LEAST))), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _splitters(part: DataFrame, rate: Column, ranges: Column, salt: int) -> list[tuple[int, int]]:
    """Quantile boundaries of a sample that takes records in proportion to their size. `part` has the column range; rate is
    the bytes that a sample stands for, ranges the number of ranges to make of each present one."""
    draw = F.pmod(F.xxhash64(F.lit(salt), "key", "doc_id", "size"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = part.withColumn("rate", rate).withColumn("ranges", ranges).where(draw < F.col("size") / F.col("rate")).withColumn("weight", F.greatest("size", "rate"))
    order = Window.partitionBy("range").orderBy("key", "doc_id")
    cut = F.floor((F.sum("weight").over(order) - F.col("weight")) * F.col("ranges") / F.sum("weight").over(Window.partitionBy("range")))
    firsts = sample.withColumn("cut", cut).groupBy("range", "cut").agg(F.min(F.struct("key", F.coalesce("doc_id", F.lit(_LEAST)).alias("doc_id"))).alias("first"))
    return sorted({(r[0], r[1]) for r in firsts.where("cut > 0").select("first.key", "first.doc_id").collect()})


def ranged(rows: DataFrame, rounds: int = 4) -> DataFrame:
    """rows with the column range. Ranges are in the order of (key, doc_id) and hold about 50,000 records, up to 4,096 of
    them at first; those with over twice an even share of records or bytes are subdivided, in up to `rounds` rounds. Tables of
    fewer records than ranges stay one range, without a sample. Ranges only decide which task orders which records: where one
    record outweighs a range, or the rounds end, it stays overfull and the shards are the same. Null ids come first among equal
    keys, repeated rows fall into one range, and an empty table has none."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    count = min(_MOST_RANGES, max(64, 1 << max(0, n // 50_000).bit_length()))
    at: list[tuple[int, int]] = []
    if n > count:
        at = _splitters(rows.withColumn("range", F.lit(0)), F.lit(max(1.0, total / count / _SAMPLES)), F.lit(count), 1)
    for turn in range(rounds):
        out = rows.withColumn("range", _range_of(at))
        full = out.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
        share = F.greatest(F.col("n") * count / F.lit(max(n, 1)), F.col("bytes") * count / F.lit(max(total, 1)))
        full = full.withColumn("share", share).where("share > 2 and n > 1").select("range", "bytes", "share")
        over = {r[0] for r in full.select("range").collect()}  # fewer than there are ranges
        if not over or n <= count:
            break
        part = out.join(F.broadcast(full), "range")
        more = _splitters(part, F.greatest(F.lit(1.0), F.col("bytes") / F.col("share") / _SAMPLES), F.ceil("share"), turn + 2)
        if not set(more) - set(at):
            break
        at = sorted({*at, *more})
    return rows.withColumn("range", _range_of(at))


def assign_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs (doc_id, text; other columns are ignored).

    The law is `bytes`: a record whose bytes begin at b of the whole order's total t is in shard floor(b * shards / t), so a shard
    differs from an even share by less than one record. Slots count from 0 in the order of (key, doc_id). grown_shard is null.
    Null and empty texts have size 1. Null ids come first among equal texts. Repeated rows take slots next to each other. An
    empty table gives no rows.
    """
    rows = materialize(records(docs), "records")
    placed = materialize(ranged(rows), "ranged")
    discard(rows)
    totals = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over ranges, not over records
    starts = totals.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"), F.sum("bytes").over(Window.partitionBy()).alias("total"))
    order = Window.partitionBy("range").orderBy("key", "doc_id", "size", "text_crc32")
    run = placed.withColumn("own_byte", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("own_row", F.row_number().over(order) - 1)
    # Ranges are bounded in number, whatever the input.
    run = run.join(F.broadcast(starts), "range").withColumn("row", F.col("row0") + F.col("own_row"))
    share = F.floor((F.col("byte0") + F.col("own_byte")) * F.lit(shards).cast("decimal(20,0)") / F.col("total").cast("decimal(20,0)"))
    run = materialize(run.select("doc_id", "size", "text_crc32", share.cast("int").alias("shard"), "row"), "placed")
    discard(placed)
    first = run.groupBy("shard").agg(F.min("row").alias("row_of_shard"))
    out = run.join(F.broadcast(first), "shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("row_of_shard")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """The rows of docs below path, in a folder for each shard (shard=0, ...), with the column slot, by the law of assign_shards.

    Columns of docs named shard and slot are replaced by these; all others are kept. Null and empty texts and null ids are rows
    like any other. Rows that share id, size and check sum take these rows' slots in any order. Texts, however long, travel once,
    with the join to their place. An empty table writes no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    own = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]).alias("own")
    keys = ["own_id", "own_size", "own_crc32"]
    keyed = docs.select(own, F.col("doc_id").cast("bigint").alias("own_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("own_size"), F.crc32(text).alias("own_crc32"))
    numbered = keyed.withColumn("own_turn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    turns = assign_shards(docs.select("doc_id", "text"), shards).select(F.col("doc_id").alias("its_id"), F.col("size").alias("own_size"), F.col("text_crc32").alias("own_crc32"), "shard", "slot")
    turns = turns.withColumn("own_turn", F.row_number().over(Window.partitionBy("its_id", "own_size", "own_crc32").orderBy("shard", "slot")))
    both = numbered.join(turns, ["own_size", "own_crc32", "own_turn"]).where(F.col("own_id").eqNullSafe(F.col("its_id")))
    both.select("own.*", "shard", "slot").write.partitionBy("shard").parquet(path)


#: text_crc32 folds over bytes with a table that a rule builds: eight shifts of each byte.
SQL = """
WITH RECURSIVE crc_table AS (SELECT list(list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, strlen(text) + 1 AS size, ('0x' || substr(md5(text), 1, 15))::BIGINT AS key, hex(encode(text)) AS h FROM texts),
crc AS (SELECT doc_id, size, key, xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(range(1, size), lambda i: ('0x' || substr(h, (2 * i - 1)::BIGINT, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c & 255, b) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM parts, crc_table),
run AS (SELECT *, sum(size) OVER (ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS b, sum(size) OVER () AS t FROM crc),
cut AS (SELECT *, (b * 16 // t)::INT AS shard FROM run)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, NULL::INT AS grown_shard FROM cut
"""
