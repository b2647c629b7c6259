"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and UTF-8 bytes that a Python worker holds at once while it maps a batch.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); unset, as in tests, a temporary one is set."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="inkmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        where = f"file://{folder}"
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and return the table read back: a cut in the lineage that
    survives lost executors and is computed once, however many plans read it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """The driver collects its garbage: until it does, the shuffle files, broadcasts and plans of what is staged stay."""
    spark.sparkContext._jvm.System.gc()


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A table of texts; with fewer files than cores its rows are dealt to all of them, as a file of one row group is
    one task. With more files, as in any large table, rows stay where they are read."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_texts(spark, f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch | pa.Array, column: str = "text"):
    """Cut a batch, or an array, so that each slice holds at most BATCH_ROWS rows and about BATCH_BYTES of ``column``."""
    import numpy as np

    held = batch if isinstance(batch, pa.Array) else batch.column(column)
    n = len(held)
    if not n:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(held), 0), dtype=np.int64)
    at = 0
    while at < n:
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + BATCH_ROWS]), BATCH_BYTES, "right")))
        yield batch.slice(at, min(end, n) - at)
        at = min(end, n)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``docs`` has them."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def tidied(mapped):
    """``mapped`` over batches, after whose last one the worker gives memory that its allocators hold back to the system:
    workers are reused, and what one task has freed would else be held through the next."""

    @wraps(mapped)
    def run(batches):
        yield from mapped(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library is that of GNU
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that an operator reads; further columns, whatever their names, don't matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """Rows kept for evaluation: crc32(doc_id as text) mod 4 is 2; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
