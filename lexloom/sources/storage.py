"""Files in any store that Spark knows: one document at a time, written whole or not at all."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

#: Bytes that are passed to the store at a time.
PIECE = 1 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path where driver and executors both write: below spark.checkpoint.dir, and only in local tests elsewhere."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = getattr(sc, "_lexloom_scratch", None) or tempfile.mkdtemp(prefix="lexloom-")
        sc._lexloom_scratch = where
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _store(spark, path)
    return store.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    store, at = _store(spark, path)
    store.delete(at, True)


def reset(spark: SparkSession, path: str) -> None:
    """An empty folder, whatever was there."""
    remove(spark, path)
    store, at = _store(spark, path)
    store.mkdirs(at)


def put(spark: SparkSession, path: str, pieces: Iterable[bytes] | bytes | str) -> int:
    """Write a file beside its place and move it there when it is whole, over what was there; returns its bytes."""
    if isinstance(pieces, str):
        pieces = pieces.encode()
    if isinstance(pieces, bytes):
        pieces = [pieces]
    store, tmp = _store(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    _, at = _store(spark, path)
    out, size = store.create(tmp, True), 0
    try:
        for piece in pieces:
            for low in range(0, len(piece), PIECE):
                out.write(bytearray(piece[low : low + PIECE]))
            size += len(piece)
        out.close()
    except BaseException:
        out.close()
        store.delete(tmp, False)
        raise
    store.delete(at, False)
    if not store.rename(tmp, at):
        raise OSError(f"can't move a file to {path}")
    return size


def copy(spark: SparkSession, source: str, target: str) -> None:
    """A file or folder as it is."""
    (a, at), (b, to) = _store(spark, source), _store(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, at, b, to, False, True, spark._jsc.hadoopConfiguration())
