"""Helpers for operators that hand Arrow batches to Python inside Spark's tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Bytes of a batch of rows that a task hands to Python, unless the session says otherwise. The default is many
# times that, for each task on either side.
BATCH_BYTES = "8m"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# Objects that are dear to build: per Python worker the last one of each kind, and what it was built for.
_kept: dict = {}


def once_per_worker(kind: str, key, build: Callable):
    """What ``build`` returns, built anew only when the worker sees another ``key`` for this ``kind``."""
    if kind not in _kept or _kept[kind][0] != key:
        _kept.pop(kind, None)
        _kept[kind] = key, build()
    return _kept[kind][1]


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with batches of bounded size, for rows that hold texts.

    Python workers outlive their tasks, so what a task has freed goes back to the system when it ends.
    """
    conf = df.sparkSession.conf
    if BYTES_SETTING not in conf.getAll:
        conf.set(BYTES_SETTING, BATCH_BYTES)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return free memory to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most_bytes`` of ``column``, or of one row if that row is longer."""
    rows = max(1, batch.num_rows)
    step = max(1, rows * most_bytes // max(1, batch.column(column).nbytes))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def each_group(make: Callable[[pa.Table], pa.Table], keys: list[str]) -> Callable:
    """A function for ``mapInArrow`` that hands ``make`` the rows of one group after another.

    Rows have to come sorted by ``keys``, all long and not null, and all rows of a group in one partition. Only a
    group and a batch are held at a time, so groups should be of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(key).to_numpy() for key in keys])
            starts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(0)) + 1
            if waiting and [waiting[0].column(key)[0].as_py() for key in keys] != places[:, 0].tolist():
                yield from make(pa.Table.from_batches(waiting)).to_batches()
                waiting = []
            for start, end in zip([0, *starts.tolist()], [*starts.tolist(), batch.num_rows]):
                if start:
                    yield from make(pa.Table.from_batches(waiting)).to_batches()
                    waiting = []
                waiting.append(batch.slice(start, end - start))
        if waiting:
            yield from make(pa.Table.from_batches(waiting)).to_batches()

    return run


def with_columns(
    df: DataFrame,
    fields: list[T.StructField],
    source: str,
    build: Callable,
    make: Callable,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` (all of ``df``) and the columns ``fields``, which ``make(state, values)`` computes from ``source``.

    ``build`` gives the state, once per task. Columns that are already called so are replaced.
    """
    made = {f.name for f in fields}
    kept = [f for f in df.schema if f.name not in made and (keep is None or f.name in keep)]
    names = [f.name for f in (*kept, *fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = build()
        for whole in batches:
            for batch in slices(whole, source):
                arrays = make(state, batch.column(source).to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *arrays], names)

    return map_arrow(df, run, T.StructType([*kept, *fields]))


def with_column(
    df: DataFrame,
    name: str,
    kind: T.DataType,
    source: str,
    build: Callable,
    make: Callable,
    keep: list[str] | None = None,
) -> DataFrame:
    """The same for one column, of which ``make`` returns the array."""
    field = T.StructField(name, kind)
    return with_columns(df, [field], source, build, lambda state, values: [make(state, values)], keep)
