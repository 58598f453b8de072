"""Session helpers: shared folders, materialised tables and shipping of code to the workers."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import shutil
import sys
import tempfile
import uuid
import weakref

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
_OPEN: set[str] = set()
_PATHS: dict[int, str] = {}


def ship_code() -> None:
    """Send this package's functions to the Python workers by value, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir`` (or the context's checkpoint folder). Only where neither is set and all is one
    process, as in tests, a folder of our own is made; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL:
            os.makedirs("/tmp/checkpoints", exist_ok=True)
            _LOCAL.append(tempfile.mkdtemp(dir="/tmp/checkpoints"))
            atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
        root = f"file://{_LOCAL[0]}"
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, which goes when the driver ends, if not before."""
    if not _OPEN:
        atexit.register(_sweep)
    path = f"{shared_root(spark)}/titlewright/{name}-{uuid.uuid4().hex}"
    _OPEN.add(path)
    return path


def _sweep() -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        spark = SparkSession.getActiveSession()
        for path in sorted(_OPEN) if spark else ():
            drop_path(spark, path)


def materialize(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again, which cuts its lineage there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = path
    weakref.finalize(out, _PATHS.pop, id(out), None)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read any more."""
    for df in tables:
        if path := _PATHS.pop(id(df), None):
            drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path below the shared folder through Hadoop's file system, wherever it lies."""
    _OPEN.discard(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings, with __ for . in their names, for the jobs that run inside; what was set before comes back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now, not when the driver next collects garbage."""
    gc.collect()
    spark._jvm.System.gc()
