"""Helpers for Arrow batches inside tasks: bounded slices and zero-copy views of texts."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text handled at a time inside a task (one longer text is a slice of its own).
SLICE_BYTES = 4 << 20


def text_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls count as empty.

    ``bytes[offsets[i]:offsets[i + 1]]`` is the UTF-8 text of row ``i``.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of ``column`` (whole rows only)."""
    _, offs = text_views(batch.column(batch.schema.get_field_index(column)))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offs, offs[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


#: Bytes of rows that go to a Python worker at once where texts are long: a batch is held on both sides.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batch_bytes(spark: SparkSession, limit: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs started inside send at most ``limit`` bytes of rows to a Python worker at once; the session's
    own setting holds again afterwards."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, str(limit))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


#: What operators remember in a worker from task to task; each entry clears one such memory.
REMEMBERED: list[Callable[[], None]] = []


def forget() -> None:
    """Called where a task of another kind starts: the worker drops what earlier operators remember."""
    for clear in REMEMBERED:
        clear()
    release()


def release() -> None:
    """Give memory that a task no longer uses back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(col: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row (null: empty), one at a time."""
    data, offs = text_views(col)
    raw = data.tobytes()
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        yield raw[a:b]


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows with equal integer ``keys``, from batches in which equal keys stand together.

    Gives (table, cuts): group ``i`` is rows ``cuts[i]`` to ``cuts[i + 1]``. Only the group that
    is still open is held back, so memory is that of a batch and the largest group.
    """
    held: list[pa.RecordBatch] = []

    def whole(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(parts)
        ids = np.stack([table.column(k).to_numpy() for k in keys], axis=1)
        return table, np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1, [len(ids)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [column(batch, k).to_numpy() for k in keys]
        other = np.flatnonzero(np.logical_or.reduce([i != i[-1] for i in ids]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if held and any(column(held[-1], k)[-1].as_py() != i[0] for k, i in zip(keys, ids)):
            yield whole(held)
            held = []
        if cut:
            yield whole([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield whole(held)
