"""Files in the shared folder, as Python workers read them; every scheme that Arrow's file systems know."""

from __future__ import annotations

from pyarrow import fs


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it. Hadoop writes file:/x for file:///x and s3a for s3."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(uri)


def parts(uri: str) -> list[tuple[fs.FileSystem, str]]:
    """The data files in a folder; none if there is no such folder."""
    system, path = open_fs(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [(system, x.path) for x in sorted(found, key=lambda x: x.path) if x.is_file and not x.base_name.startswith(("_", "."))]


def _hadoop(spark, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def create_bytes(spark, uri: str, data: bytes) -> None:
    """A new file of a few MB at most, through Hadoop's file system; an existing one is an error."""
    system, path = _hadoop(spark, uri)
    out = system.create(path, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def create_text(spark, uri: str, text: str) -> None:
    create_bytes(spark, uri, text.encode())


def read_text(spark, uri: str) -> str:
    return spark.read.text(uri, wholetext=True).first()[0]


def names(spark, uri: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    system, path = _hadoop(spark, uri)
    return [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
