"""Shared helpers: written tables in the cluster's shared folder, storage access, set-wise conf."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

#: python batches: bounded by bytes, so a run of very long texts can't fill a worker
ARROW = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
         "spark.sql.execution.arrow.maxRecordsPerBatch": "4000"}
#: shuffle files of a finished write are never read again: let Spark drop them
CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def tune(spark: SparkSession) -> None:
    """Byte-bounded Arrow batches for the session (results are evaluated after an operator returns)."""
    for k, v in ARROW.items():
        spark.conf.set(k, v)


def give_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after whose last batch the worker returns freed memory: reused workers otherwise keep the peak of every stage."""
    def lean(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)
    return lean


@contextlib.contextmanager
def _set(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    with _set(spark, CLEAN):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def dealt(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like :func:`cut`, but in buckets by ``key``: joins on it read the rows where they are, however often, and shuffle the other side alone.

    A bucket is read by one task, so ``key`` must be spread evenly.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}-{uuid.uuid4().hex}"
    path = shared_path(spark, table)
    table = table.replace("-", "_")
    with _set(spark, CLEAN):
        df.repartition(parts, key).write.format("parquet").option("path", path).bucketBy(parts, key).saveAsTable(table)
    out = spark.table(table)
    out._cut_path, out._cut_table = path, table
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete tables written by :func:`cut` or :func:`dealt` once nothing reads them any more."""
    for df in tables:
        if getattr(df, "_cut_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._cut_table}")
        path = getattr(df, "_cut_path", None)
        if path:
            delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def only(df: DataFrame, **cols: str) -> DataFrame:
    """Project to the named columns, renamed: extra columns with clashing names never reach the operator."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in cols.items()])


def open_fs(uri: str):
    """(pyarrow filesystem, path) of a shared folder: file, hdfs, s3 and gs URIs; bare paths are local."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)
