"""Saved intermediate tables and Arrow batch helpers."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 2 << 20  # text bytes handled by one vectorised step
BATCH_BYTES = 8 << 20  # bytes of rows sent to a Python worker at once; Spark's own bound is a number of rows, whatever their texts


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all machines share.

    A local-mode session without the setting (tests, laptops) gets a private
    folder of its own; a cluster without it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        path = tempfile.mkdtemp(prefix="trueform-llm-")
        spark.sparkContext.setCheckpointDir(path)  # the setting itself can't change in a running session; the context keeps the folder
    return path


def on_path(spark: SparkSession) -> None:
    """Lets Python workers that see this file system (local mode) import the package from where it lies."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches that Python workers get by bytes, so long texts don't pile up on either side of the pipe."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def lean(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``step`` of ``mapInArrow`` that gives freed memory back when its task ends.

    Workers stay for later tasks; what their allocators hold on to would count
    against the executor while other stages run.
    """
    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than the tasks since this
    table. The rows may be read any number of times and never change.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about ``limit`` text bytes, one row at least."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, end to end, and the n + 1 row offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def list_array(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, type=kind))
