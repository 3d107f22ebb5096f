"""Reading the driver tables and writing intermediate tables for llm queries."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import checkpoint_dir

#: Java pattern of the words that all contracts but one count (ASCII white space separates).
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x20\x09-\x0D]+"


#: Bytes of one Arrow batch between Spark and a Python worker; rows here are whole
#: texts, both sides hold a few copies of a batch, and the JVM's C library keeps
#: what larger buffers took.
BATCH_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, as ``--py-files`` does (once a session),
    and bound the Arrow batches they are handed."""
    import tarmac

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_tarmac_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(tarmac.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tarmac-py-"), "tarmac.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(home)))
    sc.addPyFile(archive)  # the driver serves it to the executors
    sc._tarmac_shipped = True


_released_for = -1
#: What this Python worker keeps between tasks; tasks of stages that don't use it drop it.
caches: list[dict] = []
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _trim() -> None:
    """Give back what is freed but kept by Arrow's and the C library's allocators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def release_memory(keep: dict | None = None) -> None:
    """Give back what earlier stages' tasks of this (reused) Python worker left, their
    caches but ``keep`` included; once a stage."""
    global _released_for
    context = TaskContext.get()
    if context is None or context.stageId() == _released_for:
        return
    _released_for = context.stageId()
    for cache in caches:
        if cache is not keep:
            cache.clear()
    gc.collect()
    _trim()


def giving_back(run: Run, keep: dict | None = None) -> Run:
    """``run`` for ``mapInArrow``, by workers that hold nothing of it once a task is done.

    An idle worker counts to its executor's memory as a busy one does.
    """

    @wraps(run)
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory(keep)
        try:
            yield from run(batches)
        finally:
            _trim()

    return held


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet (with the writer's ``options``) in the shared folder and read again.

    Cuts the lineage: a lost executor costs only a reread of these files.
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
