"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.session import configure, new_scratch_path, scratch_folder, written  # noqa: F401

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Small Arrow batches: a batch of very long texts must fit beside another worker's.
BATCH_ROWS = "1000"

# Characters or bytes that one vectorised step handles at once.
CHUNK = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators count on; tasks find this package where the driver does."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)
    return spark


# What this worker keeps from task to task: for one operator at a time.
_remembered: dict[tuple, object] = {}


def remembered(key: tuple, make: Callable[[], object]):
    """What ``make`` returns, kept in the worker until a task of another operator runs there."""
    if key not in _remembered:
        _remembered.clear()
        _remembered[key] = make()
    return _remembered[key]


def give_back() -> None:
    """Hand freed memory to the system: workers outlive their tasks, and else keep the most they ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def lean(run: Callable, keep: tuple | None = None) -> Callable:
    """``run`` for ``mapInArrow``, in a worker that remembers at most ``keep`` and gives memory back after each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _forget(keep):
            give_back()
        yield from run(batches)
        give_back()

    return task


def _forget(keep: tuple | None) -> bool:
    """Drop what is remembered but for ``keep``; whether there was anything."""
    others = [k for k in _remembered if k != keep]
    for k in others:
        del _remembered[k]
    if others:
        gc.collect()
    return bool(others)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A batch's texts, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def by_size(items: list, size, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes sum up to about the limit."""
    start, total = 0, 0
    for at, item in enumerate(items):
        total += size(item)
        if total >= limit:
            yield start, at + 1
            start, total = at + 1, 0
    if start < len(items):
        yield start, len(items)


def local_components(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``count`` nodes over the given links."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            return label


def whole_units(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], rows: int) -> Iterator[pa.Table]:
    """A sorted partition's rows in tables of at least ``rows`` rows that split no unit.

    A unit is a run of rows with equal keys; callers bound the size of each.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) < rows:
            continue
        joined = pa.Table.from_batches(held)
        starts = unit_starts(joined, keys)
        if len(starts) > 1:
            cut = int(starts[-1])
            yield joined.slice(0, cut)
            held = joined.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def unit_starts(rows: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Where runs of equal keys start."""
    changed = np.zeros(max(0, rows.num_rows - 1), bool)
    for key in keys:
        values = rows.column(key).to_numpy()
        changed |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(changed) + 1)) if rows.num_rows else np.zeros(0, np.int64)


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
