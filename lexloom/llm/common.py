"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Rows that a Python worker gets at a time.
BATCH_ROWS = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset (local tests) a temporary folder takes its place.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = getattr(sc, "_llm_shared", None) or tempfile.mkdtemp(prefix="llm-shared-")
        sc._llm_shared = where
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    return where


def release(collect: bool = True) -> None:
    """Give freed memory back to the system: a driver fits models and then lives on."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the shared folder; its lineage ends there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tidy(spark: SparkSession) -> None:
    """Let go of what earlier rounds have shuffled and checkpointed: Spark deletes it when the driver's objects are gone.

    The JVM holds an object until Python says that it is dropped, which a thread of py4j does up to a second
    later: what waits for it is said here, else this round's collection of garbage would find it still in use.
    """
    gc.collect()
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    while waiting:
        try:
            item = waiting.pop()
        except IndexError:  # the thread was first
            break
        if not isinstance(item, tuple):  # the mark of its end
            waiting.append(item)
            break
        item[0].garbage_collect_object(item[1], False)
    spark.sparkContext._jvm.System.gc()


def made(spark: SparkSession) -> list[str]:
    """The folders that :func:`stored` has made in this session, in order."""
    sc = spark.sparkContext
    if not hasattr(sc, "_llm_stored"):
        sc._llm_stored = []
    return sc._llm_stored


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder, and read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    made(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that :func:`stored` has made, once nothing reads them any more."""
    for path in list(paths):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        made(spark).remove(path)


def arrow_map(
    df: DataFrame,
    func: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` in batches of so few rows that long texts fit a worker's memory.

    A worker lives on and serves other stages: what a task has freed goes back to the system.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from func(batches)
        release(collect=False)

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def not_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that a model may learn from: crc32 of the id as text, mod 4, is not 2."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 != 2


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def bounded_sample(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """At most ``size`` rows, those with the least hash of ``keys``.

    The hash spreads over the whole table, so no prefix of it is preferred; a
    top-k over the hash needs neither a sort nor a shuffle of the table.
    """
    h = F.xxhash64(*[F.col(k) for k in keys])
    return rows.orderBy(h, *keys).limit(size)


def string_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with its texts; null counts as empty."""
    for batch in batches:
        yield batch, [x or "" for x in batch.column(column).to_pylist()]
