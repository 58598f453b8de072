"""Single files through Hadoop's file system, so that a path means the same to the driver and the executors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from titlewright.session import drop_path, scratch

_CHUNK = 1 << 20


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _at(spark, path)
    return system.exists(target)


def size(spark: SparkSession, path: str) -> int:
    system, target = _at(spark, path)
    return system.getFileStatus(target).getLen()


def write_file(spark: SparkSession, path: str, parts: Iterable[bytes]) -> tuple[str, int]:
    """A file of the given bytes; gives its SHA-256 and size. It appears when it is whole; if the bytes can't be had, nothing is left
    and what was there before stays."""
    system, target = _at(spark, path)
    _, part = _at(spark, path + ".part")
    sha, n, held = hashlib.sha256(), 0, bytearray()
    out = system.create(part, True)
    try:
        for data in parts:
            sha.update(data)
            n += len(data)
            held += data
            if len(held) >= _CHUNK:
                out.write(held)
                held = bytearray()
        out.write(held)
    except BaseException:
        out.close()
        system.delete(part, False)
        raise
    out.close()
    system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"can't rename to {path}")
    return sha.hexdigest(), n


def write_rows(spark: SparkSession, path: str, rows: DataFrame, sep: str, head: bytes, tail: bytes, refuse: str | None = None) -> tuple[str, int, int]:
    """A file of head, the one text column of rows in their order with sep between them, and tail; gives its SHA-256, its size and
    the number of rows. Executors write the rows, zipped, below the shared folder, and the JVM joins the parts: nothing goes through
    the driver but blocks of bytes. If a row holds the text `refuse`, nothing is written."""
    column = F.col(rows.columns[0])
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(column) + len(sep.encode())), F.lit(0)).alias("size"), F.count_if(F.contains(column, F.lit(refuse or ""))).alias("refused")]
    parts = scratch(spark, "rows")
    try:
        rows.observe(seen, *counts).write.option("lineSep", sep).option("compression", "gzip").text(parts)
        got = seen.get
        if refuse and got["refused"]:
            raise ValueError("refusing to publish: a record holds raw text")
        return (*_join(spark, path, parts, got["size"] - len(sep.encode()) if got["n"] else 0, head, tail), got["n"])
    finally:
        drop_path(spark, parts)


def _join(spark: SparkSession, path: str, parts: str, n: int, head: bytes, tail: bytes) -> tuple[str, int]:
    """head, the first n bytes of the parts' text in the order of their names, and tail."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    system, target = _at(spark, path)
    _, part = _at(spark, path + ".part")
    source, folder = _at(spark, parts)
    found = sorted((f.getPath() for f in source.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: int(p.getName().split("-")[1]))
    sha = jvm.java.security.MessageDigest.getInstance("SHA-256")
    out = jvm.java.security.DigestOutputStream(system.create(part, True), sha)
    try:
        out.write(head)
        left = n
        for p in found:
            text = jvm.java.util.zip.GZIPInputStream(source.open(p), _CHUNK)
            sized = jvm.org.apache.commons.io.input.BoundedInputStream.builder().setInputStream(text).setMaxCount(left).get()
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(sized, out, hadoop, False)
                left -= sized.getCount()
            finally:
                sized.close()
        if left:
            raise OSError(f"{left} of {n} bytes are missing in {parts}")
        out.write(tail)
        out.close()
    except BaseException:
        out.close()
        system.delete(part, False)
        raise
    size = system.getFileStatus(part).getLen()
    system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"can't rename to {path}")
    return bytes(sha.digest()).hex(), size


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def sha256(spark: SparkSession, path: str, unzip: bool = False) -> str:
    """Of a file's bytes, or of what is zipped in it. They stream through the driver's JVM, whatever their number."""
    system, source = _at(spark, path)
    jvm = spark._jvm
    sha = jvm.java.security.MessageDigest.getInstance("SHA-256")
    data = system.open(source)
    data = jvm.java.security.DigestInputStream(jvm.java.util.zip.GZIPInputStream(data, _CHUNK) if unzip else data, sha)
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, jvm.java.io.OutputStream.nullOutputStream(), spark._jsc.hadoopConfiguration(), True)
    return bytes(sha.digest()).hex()


def head(spark: SparkSession, path: str, n: int) -> bytes:
    """A file's first bytes."""
    system, source = _at(spark, path)
    data = system.open(source)
    try:
        return bytes(data.readNBytes(n))
    finally:
        data.close()


def gzip_copy(spark: SparkSession, path: str) -> str:
    """path.gz beside the file, the same for the same content."""
    system, source = _at(spark, path)
    _, target = _at(spark, path + ".gz")
    jvm = spark._jvm
    zipped = jvm.java.util.zip.GZIPOutputStream(system.create(target, True))
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(system.open(source), zipped, spark._jsc.hadoopConfiguration(), True)
    return path + ".gz"


def copy(spark: SparkSession, source: str, target: str) -> None:
    a, b = _at(spark, source), _at(spark, target)
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a[0], a[1], b[0], b[1], False, True, spark._jsc.hadoopConfiguration()):
        raise OSError(f"can't copy {source} to {target}")
