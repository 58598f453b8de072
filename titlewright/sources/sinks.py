"""Writing what is published: labels, vectors, manifest and report. Executors write the rows of labels and lists, which are then
joined into one file; vectors stream through the driver one partition at a time."""

from __future__ import annotations

import hashlib
import json
import os
import struct
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlewright.functions.text import row_hex
from titlewright.sources.storage import write_file, write_rows

EMBEDDING, QUANTIZATION = "e02", "int8-symmetric-x127"


def json_number(x: Column) -> Column:
    """A double as JSON, whole ones without a fraction."""
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("string"))


def json_string(s: Column) -> Column:
    """A quoted string with escaped slashes."""
    quoted = F.regexp_extract(F.to_json(F.struct(s.alias("s"))), r"(?s)^\{\"s\":(.*)\}$", 1)
    return F.replace(quoted, F.lit("/"), F.lit("\\/"))


def _labels(column: str) -> Column:
    each = F.transform(column, lambda x: F.concat(F.lit('{"confidence":'), json_number(x["confidence"]), F.lit(',"label":"'), F.replace(F.replace(x["label"], F.lit('"'), F.lit('\\"')), F.lit("/"), F.lit("\\/")), F.lit('"}')))
    return F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))


def record_json(df: DataFrame) -> DataFrame:
    """df with the column json: the record as one line with its keys in order."""
    text = lambda s: F.lit(s)
    return df.withColumn(
        "json",
        F.concat(
            text('{"animated":'), F.col("animated").cast("string"), text(',"mediaType":'), json_string(F.col("media_type")), text(',"moods":'), _labels("moods"), text(',"primaryGenre":'), json_string(F.col("primary_genre")),
            text(',"source":'), json_string(F.col("source")), text(',"subgenres":'), _labels("subgenres"), text(',"tmdbId":'), F.col("tmdb_id").cast("string"), text("}"),
        ),
    )


def leaks(df: DataFrame, word: str = "overview") -> DataFrame:
    """One row: records, leaking (those whose json holds the word)."""
    return df.agg(F.count("*").alias("records"), F.count_if(F.contains("json", F.lit(word))).alias("leaking"))


def _rows(df: DataFrame, column: str) -> Iterator:
    return (r[0] for r in df.select(column).toLocalIterator(prefetchPartitions=True))


def write_labels(records: DataFrame, path: str, version: str, count: int) -> tuple[str, int]:
    """The artifact {count, records, taxonomyVersion}; records come in the table's order. Gives its hash and size."""
    tail = b'],"taxonomyVersion":"%s"}' % version.encode()
    return write_rows(records.sparkSession, path, record_json(records).select("json"), ",", b'{"count":%d,"records":[' % count, tail, "overview")[:2]


def write_vectors(records: DataFrame, path: str, count: int, dim: int) -> tuple[str, int]:
    """Count and dimension as little-endian 32-bit integers, then the vectors' bytes. Gives its hash and size."""
    rows = _rows(records.select(F.unhex(row_hex(F.col("v"))).alias("row")), "row")
    return write_file(records.sparkSession, path, chain([struct.pack("<ii", count, dim if count else 0)], map(bytes, rows)))


def json_line(df: DataFrame, name: str = "json") -> DataFrame:
    """df's rows as lines of JSON with their keys in order and nulls written out."""
    columns = sorted(df.columns)
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]), {"ignoreNullFields": "false"}).alias(name))


def write_list(df: DataFrame, path: str) -> int:
    """df's rows, in its order, as one list of JSON with a line for each; gives their number."""
    return write_rows(df.sparkSession, path, json_line(df), ",\n", b"[\n", b"\n]\n")[2]


def version_of(labels_sha: Column, vectors_sha: Column) -> Column:
    """The version of a dataset whose files have these hashes."""
    return F.substring(F.sha2(F.concat_ws(":", labels_sha, vectors_sha), 256), 1, 12)


def dataset_version(labels_sha: str, vectors_sha: str) -> str:
    return hashlib.sha256(f"{labels_sha}:{vectors_sha}".encode()).hexdigest()[:12]


def write_json(spark: SparkSession, value, path: str, pretty: bool = True) -> None:
    write_file(spark, path, [json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2 if pretty else None).encode()])


def manifest(labels: tuple[str, str, int], vectors: tuple[str, str, int], count: int, dims: int, version: str, built: datetime | None = None) -> dict:
    """The fifteen fields of the manifest. labels and vectors: path, hash and size."""
    built = built or datetime.now(timezone.utc)
    name = os.path.basename
    return {
        "datasetVersion": dataset_version(labels[1], vectors[1]), "taxonomyVersion": version, "embeddingModel": EMBEDDING, "dims": dims if count else 0, "count": count, "quantization": QUANTIZATION, "labelsFile": name(labels[0]),
        "vectorsFile": name(vectors[0]), "labelsGzFile": name(labels[0]) + ".gz", "labelsSha256": labels[1], "labelsBytes": labels[2], "vectorsSha256": vectors[1], "vectorsBytes": vectors[2],
        "builtAt": built.strftime("%Y-%m-%dT%H:%M:%SZ"), "lastModifiedHttp": built.strftime("%a, %d %b %Y %H:%M:%S GMT"),
    }
