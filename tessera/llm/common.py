"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows of a record batch handed to Python; texts stay whole, so this bounds a worker's memory.
BATCH_ROWS = 1000
#: Bytes of a record batch handed to Python.
BATCH_BYTES = 16 << 20
#: The words of most operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)  # glibc's


def release() -> None:
    """Give a worker's free memory back: it lives on beside the tasks that follow."""
    pa.default_memory_pool().release_unused()
    _TRIM(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for workers that hold whole long texts."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release()

    return df.mapInArrow(run, schema)


def row_slices(b: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of up to ``size`` bytes of ``column``, a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < b.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield b.slice(at, stop - at)
        at = stop


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[None]:
    """Record batches of up to ``rows`` rows and ``size`` bytes for the jobs run inside; the caller's settings come back after."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def words_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a column of texts, encoded.

    Returns ``(starts, codes, words)``: document *d* has the words
    ``words[codes[k]]`` for *k* from ``starts[d]`` to ``starts[d + 1]``.  A null
    text has no words.
    """
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(full)])[offsets]
    enc = flat.filter(pa.array(full)).dictionary_encode()
    return starts.astype(np.int64), enc.indices.to_numpy().astype(np.int64), enc.dictionary


def document_of(starts: np.ndarray) -> np.ndarray:
    """Document number of each word."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def per_document(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one per word) over each document."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[starts[1:]] - sums[starts[:-1]]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted different values (a sort is faster than the hash table of np.unique here)."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values
