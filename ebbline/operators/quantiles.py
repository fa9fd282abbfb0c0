"""Exact quantiles of many columns by radix selection, without sorting any of them.

A double is read as a whole number of 64 bits in the same order. All values are counted by the leading bits of
that number, all columns in one pass; every wanted rank then lies in one known part, and only the values of
these parts are counted by the following bits. After ``len(SHIFTS)`` passes at most a part is a single value,
whatever the values are. Parts of few rows are counted value by value at once, which ends the search earlier.

Tasks count in numpy; counts are combined before they move. Per pass the driver gets a row per part in use: at most 4,094 for each
column at first, then at most 8,192 for each part looked at.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ebbline.session import ship_package

# Bits of the number that a pass leaves open: sign and exponent first, then thirteen bits a time.
SHIFTS = (52, 39, 26, 13, 0)
# Parts of at most so many rows are counted value by value.
COUNTED_ROWS = 4_096
# Rows that a task counts at a time, at least, but for the last.
BATCH_ROWS = 131_072


def _value(code: int) -> float:
    """The double with this number."""
    size = struct.unpack("<d", struct.pack("<q", abs(code)))[0]
    return -size if code < 0 else size


def _codes(values: np.ndarray) -> np.ndarray:
    """The numbers of doubles: their bits, those of their size negated where they are negative."""
    bits = np.abs(values).view(np.int64)
    return np.where(values < 0, -bits, bits)


def _with_code(df: DataFrame) -> DataFrame:
    """Add ``code``, the number of the double ``value``."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(batch.column("value").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes)], [*batch.schema.names, "code"])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField("code", T.LongType())]))


@dataclass
class _Wanted:
    """The value at one rank of a column, and the part of the numbers that holds it."""

    column: str
    rank: int
    part: int = 0
    below: int = 0


def _count(df: DataFrame, entries: Sequence[tuple], above: int, shift: int) -> dict[tuple, list[tuple[int, int]]]:
    """One pass: rows by part for each of the entries, in order of the parts.

    An entry is a column, or a column and one of the parts by the bits from ``above`` on, whose values alone count.
    Missing values do not. Tasks count ``BATCH_ROWS`` rows at a time, so that few counts move.
    """
    ship_package(df.sparkSession)
    names = list(dict.fromkeys(column for column, *_ in entries))
    numbers = df.selectExpr(*[f"CAST({name} AS DOUBLE) AS c{i}" for i, name in enumerate(names)])

    def counted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        codes = {}
        for i, name in enumerate(names):
            values = np.concatenate([batch.column(i).to_numpy(zero_copy_only=False) for batch in batches])
            codes[name] = _codes(values[np.isfinite(values)])
        found = []
        for place, (name, *part) in enumerate(entries):
            own = codes[name][codes[name] >> above == part[0]] if part else codes[name]
            parts, rows = np.unique(own >> shift, return_counts=True)
            found.append((np.full(len(parts), place, np.int32), parts, rows))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)) for cells in zip(*found)], ["place", "part", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= BATCH_ROWS:
                yield counted(waiting)
                waiting = []
        if waiting:
            yield counted(waiting)

    counts = numbers.mapInArrow(run, "place int, part long, rows long").groupBy("place", "part").agg(F.sum("rows").alias("rows"))
    parts: dict[tuple, list[tuple[int, int]]] = {key: [] for key in entries}
    for row in counts.collect():
        parts[entries[row["place"]]].append((row["part"], row["rows"]))
    return {key: sorted(own) for key, own in parts.items()}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[tuple[str, float], float | None]:
    """Quantiles with linear interpolation between neighbours; missing values are ignored.

    ``df`` is read at most ``len(SHIFTS)`` times, so stage it if it is costly to compute.
    """
    parts = _count(df, [(c,) for c in dict.fromkeys(columns)], SHIFTS[0], SHIFTS[0])
    totals = {c: sum(rows for _, rows in parts[c,]) for c in columns}
    ranks = {(c, p): p * (totals[c] - 1) for c in columns for p in probabilities if totals[c]}
    wanted = {(c, at): _Wanted(c, at) for (c, _), rank in ranks.items() for at in (math.floor(rank), math.ceil(rank))}
    listed = {(c, at): parts[c,] for c, at in wanted}
    shift = SHIFTS[0]
    while wanted:
        most = 0
        for key, want in wanted.items():
            for part, rows in listed[key]:
                if want.rank < want.below + rows:
                    want.part, most = part, max(most, rows)
                    break
                want.below += rows
        if shift == 0:
            break
        # Several ranks may lie in one part, which is counted once.
        inside = list(dict.fromkeys((want.column, want.part) for want in wanted.values()))
        above, shift = shift, 0 if most <= COUNTED_ROWS else next(s for s in SHIFTS if s < shift)
        parts = _count(df, inside, above, shift)
        listed = {key: parts[want.column, want.part] for key, want in wanted.items()}

    result: dict[tuple[str, float], float | None] = {(c, p): None for c in columns for p in probabilities}
    for (c, p), rank in ranks.items():
        low, high = (_value(wanted[c, at].part) for at in (math.floor(rank), math.ceil(rank)))
        share = rank - math.floor(rank)
        result[c, p] = low * (1 - share) + high * share
    return result
