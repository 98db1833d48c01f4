"""Helpers of the corpus operators: tables, text buffers, hashes, runs of sorted rows."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import checkpoint_folder, cut_lineage

__all__ = [
    "bounded_batches",
    "checkpoint_folder",
    "cut_lineage",
    "free_memory",
    "free_name",
    "frugal",
    "mix",
    "named",
    "read_table",
    "row_ranges",
    "sha256_hex",
    "text_or_empty",
    "text_buffer",
]

# Bytes of text that are worked on at once in a task; one longer text is a piece of its own.
CHUNK_BYTES = 256 << 10

# Bytes of one batch that Python tasks get, a longer row aside. Spark's own limit of 10,000
# rows holds texts of any size; such a batch is in memory several times on either side.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, for Python tasks: its session sends them batches of BATCH_BYTES from now on.

    A limit that the session has been given stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as it takes to be no column of ``df``.

    Spark compares names without regard to case.
    """
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def named(df: DataFrame) -> list[Column]:
    """All columns of ``df``, also those whose names hold dots."""
    return [F.col(f"`{c}`") for c in df.columns]


# The module that holds what the tasks of a Python worker keep for the next ones.
WORKER_STATE = "_loanlens_worker"


def free_memory(tables: bool = True) -> None:
    """Gives freed memory back to the system: a worker lives on, beside others, after its task.

    With ``tables`` also what earlier tasks of other operators keep in this worker.
    """
    if tables:
        sys.modules.pop(WORKER_STATE, None)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, which frees memory before and after a task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        yield from run(batches)
        free_memory()

    return task


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(column) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_ranges(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes each, or of a single longer row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h
