"""Gradient boosting of regression trees on binned columns, all fits of a grid side by side.

Columns are cut into at most ``max_bins`` bins at quantiles, once for all fits. A pass over the rows then does the next
step of every fit, whatever its depth and fold: a task adds up, for the nodes that each fit is about to split,
count, gradient (and curvature) by column and bin; these sums, whose size does not depend on the rows, are added by fit
and node, and the driver takes the best splits. Of two siblings the smaller is measured, the other is the rest of their
parent. A grid with its refits thus takes as many passes as its deepest single fit. The depths' models of all rows grow
with the folds' models, and the best depth's is kept.

By default trees are MLlib's: columns drawn anew at every node, variance gain of the gradients of its
logistic loss, leaves that hold mean gradients, a first tree of the labels themselves. With ``columns_per_tree`` columns
are drawn once a tree, rows weigh as much as the curvature of their loss, so that splits are chosen by the second-order
gain, and a leaf's value is G / (H + penalty).

A finished tree is SQL: nested CASE expressions over the input columns. So is the whole model, which makes it an
ordinary stage of a pipeline that Spark evaluates, stores and loads.

Rows are written with their margins every ``STAGED_TREES`` trees; in between a pass adds up the trees grown since.
They are written in blocks, a binary value for the bins of ``BLOCK_ROWS`` rows, so that a pass hands few large values to
Python, one block at a time, and not every cell. Trees since are looked up for the rows that a node is measured on alone. Fits of one fold whose trees are equal so far share their margins and sums.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline.functions.cells import double_literal
from ebbline.operators.metrics import roc_auc
from ebbline.options import ModelOptions
from ebbline.session import delete, ship_package, stage

STAGED_TREES = 5
# Rows of a block, at least, but for the last of a task.
BLOCK_ROWS = 131_072
# Spark's setting for the rows that go to Python at once. A row is a block here, and the next is read during its sums.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Curvature below this is as good as none.
LEAST_CURVATURE = 1e-16
# A gain below this share of a node's own term is what rounding leaves of none.
LEAST_GAIN = 1e-10
# Places in the sums of a node: rows, gradient and, with columns drawn per tree, curvature.
ROWS, GRADIENT, CURVATURE = 0, 1, 2


@dataclass(frozen=True)
class Tree:
    """A tree as SQL for the number of a row's leaf, with the leaves' values and the columns it was grown on."""

    leaf: str
    values: tuple[float, ...]
    columns: tuple[str, ...]

    def sql(self) -> str:
        """The value of a row's leaf."""
        return re.sub(r"\bleaf_(\d+)\b", lambda m: double_literal(self.values[int(m[1])]), self.leaf)


@dataclass(frozen=True)
class Boosted:
    """Trees in order of growth; their values add up to the log odds of the label 1, divided by ``per_margin``."""

    trees: tuple[Tree, ...]
    per_margin: int = 1

    def margin(self) -> str:
        return " + ".join(tree.sql() for tree in self.trees) or "0D"

    def stage(self) -> SQLTransformer:
        """Adds rawPrediction (the margin), probability of the label 1 and prediction."""
        margin = f"SELECT *, {self.margin()} AS rawPrediction FROM __THIS__"
        chance = f"1 / (1 + exp(-{self.per_margin} * rawPrediction)) AS probability"
        return SQLTransformer(
            statement=f"SELECT *, {chance}, CAST(rawPrediction > 0 AS DOUBLE) AS prediction FROM ({margin})"
        )


@dataclass(frozen=True)
class Fit:
    """One model to be grown: its depth, and the fold it does not learn from."""

    depth: int
    held: int | None = None


@dataclass(frozen=True)
class Placed:
    """Splits, as column and last bin of the left side by node, and the number of each node without a split.

    The root is node 1, the children of n are 2n and 2n + 1. ``values`` are those of the numbers: of leaves in a
    finished tree, and which sums a row adds to, or -1, in a tree that grows.
    """

    splits: dict[int, tuple[int, int]]
    ends: dict[int, int]
    values: np.ndarray

    def of_rows(self, bins: np.ndarray) -> np.ndarray:
        """The value of every row; ``bins`` are those of one column after the other."""
        # As few bytes as the numbers need, and no branches: a child's numbers are taken by a mask of all bits or none.
        kind = np.uint8 if len(self.values) <= 256 else np.uint32

        def place(node: int):
            if node not in self.splits:
                return kind(self.ends[node])
            column, limit = self.splits[node]
            low, high = place(2 * node), place(2 * node + 1)
            above = (bins[column] > limit).astype(kind, copy=False)
            return low ^ (above * (low ^ high) if np.ndim(low) + np.ndim(high) == 0 else (low ^ high) & -above)

        found = place(1)
        return self.values.take(found) if np.ndim(found) else np.full(bins.shape[1], self.values[found])


@dataclass(frozen=True)
class Step:
    """What a pass has to know of a fit: trees since the margins were written, and the nodes to be measured.

    ``stored`` is the number of the written margins, ``like`` an earlier fit that has the same trees and rows.
    """

    held: int | None
    number: int
    recent: tuple[Placed, ...]
    growing: Placed | None
    nodes: int
    stored: int | None = None
    like: int | None = None


def drawn_columns(columns: Sequence[str], options: ModelOptions, tree: int) -> tuple[str, ...]:
    """The share of the columns that this tree may use, in their order; at least one."""
    count = max(1, int(options.feature_fraction * len(columns)))
    drawn = set(random.Random(f"{options.seed}-{tree}").sample(range(len(columns)), count))
    return tuple(c for i, c in enumerate(columns) if i in drawn)


def _drawn_at(count: int, options: ModelOptions, tree: int, node: int) -> list[int]:
    """The columns, by place, that a node may split on; as many as MLlib draws."""
    share = max(1, math.ceil(options.feature_fraction * count))
    return sorted(random.Random(f"{options.seed}-{tree}-{node}").sample(range(count), share))


def bin_limits(rows: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """For each column the upper limits of all bins but the last, halfway between neighbouring quantiles."""
    shares = [i / (bins - 1) for i in range(bins)] if bins > 1 else [0.5]

    def between(values: list[float]) -> np.ndarray:
        points = sorted(set(values))
        halves = [a + (b - a) / 2 for a, b in zip(points, points[1:])]
        return np.array([h if a <= h < b else a for a, b, h in zip(points, points[1:], halves)], dtype=float)

    return [between(found) for found in rows.approxQuantile(list(columns), shares, 0.25 / bins)]


def _binned(rows: DataFrame, columns: Sequence[str], limits: list[np.ndarray]) -> DataFrame:
    """Row numbers, labels, folds (-1: none) and bins of all columns, written once, a block of rows in a row.

    Numbers of rows are written down: the sample of a tree must not change when a task is repeated.
    """
    kind = _kind(limits)

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        label = table.column("label")
        if label.null_count or np.isnan(label.to_numpy()).any():
            raise ValueError("labels must not be null or NaN")
        bins = np.empty((len(limits), table.num_rows), kind)
        for place, (limit, column) in enumerate(zip(limits, table.columns[3:])):
            values = column.to_numpy()
            if column.null_count or np.isnan(values).any():
                raise ValueError("columns to learn from must not be null or NaN")
            bins[place] = np.searchsorted(limit, values)
        fold = table.column("fold").fill_null(-1).to_numpy()
        cells = [table.column("row").to_numpy(), fold, label.to_numpy(), bins]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= BLOCK_ROWS:
                yield block(waiting)
                waiting = []
        if any(b.num_rows for b in waiting):
            yield block(waiting)

    fold = F.col("fold").cast("int") if "fold" in rows.columns else F.lit(None).cast("int")
    parts = rows.sparkSession.sparkContext.defaultParallelism
    numbered = rows.select(fold.alias("fold"), F.col("label").cast("double").alias("label"), *columns).repartition(parts)
    numbered = numbered.select(F.monotonically_increasing_id().alias("row"), "fold", "label", *columns)
    return stage(numbered.mapInArrow(run, ", ".join(f"{name} binary" for name in BLOCK)), "boosting")


# The columns of a block; margins m0, m1, ... follow when trees have grown.
BLOCK = ["row", "fold", "label", "bins"]


def _kind(limits: Sequence) -> type:
    """The type of bins' numbers."""
    return np.uint8 if max(map(len, limits), default=0) < 256 else np.uint16


@dataclass(frozen=True)
class Block:
    """Rows of a task: their numbers, folds, labels, bins by column and written margins."""

    row: np.ndarray
    fold: np.ndarray
    label: np.ndarray
    bins: np.ndarray
    stored: list[np.ndarray]

    def margin(self, step: Step) -> np.ndarray:
        return _margin(step, self.bins, None if step.stored is None else self.stored[step.stored])


def _margin(step: Step, bins: np.ndarray, stored: np.ndarray | None) -> np.ndarray:
    """The written margins, if any, with the trees since added."""
    margin = np.zeros(bins.shape[1]) if stored is None else stored
    for tree in step.recent:
        margin = margin + tree.of_rows(bins)
    return margin


def _blocks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[Block]:
    for batch in batches:
        for cells in zip(*batch.columns):
            row, fold, label, bins, *stored = (cell.as_buffer() for cell in cells)
            row = np.frombuffer(row, np.int64)
            kind = np.uint8 if bins.size == columns * len(row) else np.uint16
            yield Block(
                row,
                np.frombuffer(fold, np.int32),
                np.frombuffer(label),
                np.frombuffer(bins, kind).reshape(columns, len(row)),
                [np.frombuffer(margin) for margin in stored],
            )


@contextmanager
def _block_by_block(spark: SparkSession) -> Iterator[None]:
    """Inside, rows go to Python one by one. The setting is the session's; other jobs get small batches meanwhile."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, "1")
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def _sampled(row: np.ndarray, options: ModelOptions, number: int) -> np.ndarray:
    """Which rows the tree learns from, by a hash of their number."""
    start = random.Random(f"{options.seed}-{number}-rows").getrandbits(64)
    z = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return z % np.uint64(1_000_000) < np.uint64(int(options.subsampling_rate * 1_000_000))


def _weights(label: np.ndarray, margin: np.ndarray, first: bool, options: ModelOptions) -> list[np.ndarray | None]:
    """What rows add to the sums of their node: one, gradient and curvature."""
    if options.columns_per_tree:
        chance = 1 / (1 + np.exp(-margin))
        return [None, label - chance, np.maximum(chance * (1 - chance), LEAST_CURVATURE)]
    sign = 2 * label - 1
    return [None, sign if first else 4 * sign / (1 + np.exp(np.minimum(2 * sign * margin, 700)))]


def _added(blocks: Iterator[Block], steps: Sequence[Step], sizes: Sequence[int], options: ModelOptions) -> list:
    """Sums of the blocks by fit, each of shape (nodes, bins of all columns, places); None for fits not measured."""
    starts = np.cumsum([0, *sizes]).tolist()
    alone = [step.growing is not None and step.like is None for step in steps]
    shape = (3 if options.columns_per_tree else 2,)
    sums = [np.zeros((*shape, step.nodes, starts[-1])) if mine else None for step, mine in zip(steps, alone)]
    measured = [(step, total) for step, total in zip(steps, sums) if total is not None]
    for block in blocks:
        samples = {number: _sampled(block.row, options, number) for number in {step.number for step, _ in measured}}
        for step, total in measured:
            node = step.growing.of_rows(block.bins) if step.growing.splits else None
            mine = samples[step.number] if node is None else samples[step.number] & (node >= 0)
            if step.held is not None:
                mine = mine & (block.fold != step.held)
            # Everything below is done for the rows that count alone.
            mine = np.flatnonzero(mine)
            bins = block.bins.take(mine, 1)
            margin = _margin(step, bins, None if step.stored is None else block.stored[step.stored].take(mine))
            weights = _weights(block.label.take(mine), margin, step.number == 0, options)
            node = node.take(mine) if step.nodes > 1 else None
            for column, size, start in zip(bins, sizes, starts):
                key = column.astype(np.intp) if node is None else node * size + column
                for place, weight in enumerate(weights):
                    found = np.bincount(key, weight, step.nodes * size).reshape(step.nodes, size)
                    total[place, :, start : start + size] += found
    return [None if total is None else np.ascontiguousarray(np.moveaxis(total, 0, -1)) for total in sums]


def _measure(here: DataFrame, steps: Sequence[Step], sizes: Sequence[int], options: ModelOptions) -> dict:
    """Sums by fit and node, each of shape (bins of all columns, places), in one pass over the rows."""
    places = 3 if options.columns_per_tree else 2

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _added(_blocks(batches, len(sizes)), steps, sizes, options)
        rows = [(i, n, t[n].tobytes()) for i, t in enumerate(sums) if t is not None for n in range(len(t)) if t[n].any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["fit", "node", "sums"])

    def combine(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(part.as_py()) for part in parts.column("sums"))
        return parts.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()]))

    schema = "fit long, node long, sums binary"
    found = here.mapInArrow(add_up, schema).groupBy("fit", "node").applyInArrow(combine, schema)
    # A row per node that is measured, of the same size whatever the input.
    with _block_by_block(here.sparkSession):
        sums = {(r["fit"], r["node"]): np.frombuffer(r["sums"]).reshape(-1, places) for r in found.collect()}
    fits = [i if step.like is None else step.like for i, step in enumerate(steps)]
    nodes = ((i, fit, node) for i, fit in enumerate(fits) for node in range(steps[i].nodes))
    return {(i, node): sums[fit, node] for i, fit, node in nodes if (fit, node) in sums}


@dataclass
class Grower:
    """The trees of one fit, and the tree that is growing."""

    fit: Fit
    columns: Sequence[str]
    limits: list[np.ndarray]
    options: ModelOptions
    trees: list[Tree] = field(default_factory=list)
    recent: list[Placed] = field(default_factory=list)
    stored: int | None = None

    def __post_init__(self):
        widths = np.array([len(limit) + 1 for limit in self.limits])
        self.starts = np.cumsum([0, *widths])
        # The place of every column's bins among all, or the place after all; and which bins may end a left side.
        bins = np.arange(widths.max())
        self.cells = np.where(bins < widths[:, None], self.starts[:-1, None] + bins, self.starts[-1])
        self.inner = bins < widths[:, None] - 1
        self._plant()

    def _plant(self) -> None:
        self.splits: dict[int, tuple[int, int]] = {}
        self.totals: dict[int, np.ndarray] = {}
        # Nodes to be measured, and the sums of the parents of those that are no root.
        self.wanted: list[int] = [1]
        self.parents: dict[int, np.ndarray] = {}

    @property
    def done(self) -> bool:
        return len(self.trees) == self.options.max_iter

    def step(self) -> Step:
        """The next pass's part for this fit; nothing to measure when it is done or waits for its margins."""
        number = len(self.trees)
        if self.done or len(self.recent) == STAGED_TREES:
            return Step(self.fit.held, number, tuple(self.recent), None, 0, self.stored)
        ends = sorted(self._ends())
        values = np.array([self.wanted.index(n) if n in self.wanted else -1 for n in ends], dtype=np.int64)
        growing = Placed(dict(self.splits), {n: i for i, n in enumerate(ends)}, values)
        return Step(self.fit.held, number, tuple(self.recent), growing, len(self.wanted), self.stored)

    def state(self) -> tuple:
        """What equal fits have in common: the rows, all trees, and the tree that grows."""
        growing = tuple(self.splits.items()), tuple(self.wanted), len(self.recent), self.stored
        return self.fit.held, growing, tuple(tree for tree in self.trees)

    def _ends(self) -> list[int]:
        """Nodes without a split, depth first."""

        def below(node: int) -> list[int]:
            return below(2 * node) + below(2 * node + 1) if node in self.splits else [node]

        return below(1)

    def take(self, measured: list[np.ndarray | None]) -> None:
        """Split the measured nodes and their siblings; finish the tree when nothing is left to be split."""
        known = {}
        for node, sums in zip(self.wanted, measured):
            sums = np.zeros((self.starts[-1], 3 if self.options.columns_per_tree else 2)) if sums is None else sums
            known[node] = sums
            if node in self.parents:
                known[node ^ 1] = self.parents[node] - sums
        if 1 in known:
            self.totals[1] = known[1][: self.starts[1]].sum(0)
        self.wanted, self.parents = [], {}
        for node, sums in known.items():
            best = self._best(node, sums)
            if best is None:
                continue
            self.splits[node], left = best[:2], best[2]
            self.totals[2 * node], self.totals[2 * node + 1] = left, self.totals[node] - left
            if (2 * node).bit_length() <= self.fit.depth:
                smaller = 2 * node + int(left[ROWS] > self.totals[2 * node + 1][ROWS])
                self.wanted.append(smaller)
                self.parents[smaller] = sums
        if not self.wanted:
            self._finish()

    def _best(self, node: int, sums: np.ndarray) -> tuple[int, int, np.ndarray] | None:
        """Column, last bin of the left side and the left side's sums of the split with the largest gain."""
        total = self.totals[node]
        if node.bit_length() > self.fit.depth or total[ROWS] < 2:
            return None
        if self.options.columns_per_tree:
            drawn = drawn_columns(self.columns, self.options, len(self.trees))
            allowed = [i for i, c in enumerate(self.columns) if c in drawn]
        else:
            allowed = _drawn_at(len(self.columns), self.options, len(self.trees), node)
        weight = sums.shape[1] - 1 if self.options.columns_per_tree else ROWS
        own = total[GRADIENT] ** 2 / total[weight]
        # All columns at once, each filled up to the widest with bins that hold nothing.
        left = np.append(sums, np.zeros((1, sums.shape[1])), 0)[self.cells[allowed]].cumsum(1)
        right = total - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[..., GRADIENT] ** 2 / left[..., weight] + right[..., GRADIENT] ** 2 / right[..., weight] - own
        possible = (left[..., ROWS] >= 1) & (right[..., ROWS] >= 1) & (left[..., weight] > 0) & (right[..., weight] > 0)
        gain = np.where(possible & self.inner[allowed] & (gain >= self.options.min_info_gain * total[weight]), gain, -1.0)
        column, limit = np.unravel_index(gain.argmax(), gain.shape)
        if not gain[column, limit] > LEAST_GAIN * own:
            return None
        return allowed[column], int(limit), left[column, limit]

    def _finish(self) -> None:
        ends, options = self._ends(), self.options
        sums = np.array([self.totals[n] for n in ends])
        if options.columns_per_tree:
            values = options.step_size * sums[:, GRADIENT] / (sums[:, CURVATURE] + options.leaf_penalty)
        else:
            values = (options.step_size if self.trees else 1.0) * sums[:, GRADIENT] / np.maximum(sums[:, ROWS], 1)
        numbers = {n: i for i, n in enumerate(ends)}

        def sql(node: int) -> str:
            if node in numbers:
                return f"leaf_{numbers[node]}"
            column, limit = self.splits[node]
            condition = f"{self.columns[column]} <= {double_literal(float(self.limits[column][limit]))}"
            return f"CASE WHEN {condition} THEN {sql(2 * node)} ELSE {sql(2 * node + 1)} END"

        used = drawn_columns(self.columns, options, len(self.trees)) if options.columns_per_tree else tuple(self.columns)
        self.trees.append(Tree(sql(1), tuple(values.tolist()), used))
        self.recent.append(Placed(dict(self.splits), numbers, values))
        self._plant()


def _steps(growers: Sequence[Grower]) -> list[Step]:
    """The next pass's part of each fit. Until a tree reaches the lesser depth, fits of two depths do the same."""
    first: dict[tuple, int] = {}
    found = [first.setdefault(grower.state(), i) for i, grower in enumerate(growers)]
    return [replace(g.step(), like=None if like == i else like) for i, (g, like) in enumerate(zip(growers, found))]


def _with_margins(here: DataFrame, steps: Sequence[Step], columns: int) -> DataFrame:
    """The blocks written with the margins of all fits that are like no earlier one."""
    alone = [step for step in steps if step.like is None]
    names = [*BLOCK, *[f"m{i}" for i in range(len(alone))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, block in enumerate(_blocks(iter([batch]), columns)):
                margins = [pa.array([block.margin(step).tobytes()], pa.binary()) for step in alone]
                kept = [batch.column(name).slice(place, 1) for name in BLOCK]
                yield pa.RecordBatch.from_arrays([*kept, *margins], names)

    with _block_by_block(here.sparkSession):
        return stage(here.mapInArrow(run, ", ".join(f"{name} binary" for name in names)), "boosting")


def _scored(here: DataFrame, steps: Sequence[Step], columns: int) -> DataFrame:
    """The rows' label, fold and margins m0, m1, ... under all fits, written once."""
    names = ["label", "fold", *[f"m{i}" for i in range(len(steps))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, columns):
            margins: list[np.ndarray] = []
            for step in steps:
                margins.append(block.margin(step) if step.like is None else margins[step.like])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (block.label, block.fold, *margins)], names)

    margins = ", ".join(f"{name} double" for name in names[2:])
    with _block_by_block(here.sparkSession):
        return stage(here.mapInArrow(run, f"label double, fold int, {margins}"), "boosting")


def _forget(staged: DataFrame) -> None:
    """Delete a table that was staged here."""
    for folder in {path.rsplit("/", 1)[0] for path in staged.inputFiles()}:
        delete(staged.sparkSession, folder)


def grow_all(
    rows: DataFrame, columns: Sequence[str], fits: Sequence[Fit], options: ModelOptions, score: bool = False
) -> tuple[list[Boosted], DataFrame | None]:
    """Grow ``max_iter`` trees for each of the fits on rows with the given columns, a label, 0 or 1, and a fold.

    With ``score`` also the rows' label, fold (-1: none) and margins m0, m1, ... under the fits.
    """
    spark = rows.sparkSession
    ship_package(spark)
    limits = bin_limits(rows, columns, options.max_bins)
    here = _binned(rows, columns, limits)
    sizes = [len(limit) + 1 for limit in limits]
    growers = [Grower(fit, columns, limits, options) for fit in fits]
    while not all(grower.done for grower in growers):
        steps = _steps(growers)
        if not any(step.growing for step in steps):
            before, here = here, _with_margins(here, steps, len(columns))
            _forget(before)
            written = [i for i, step in enumerate(steps) if step.like is None]
            for i, (grower, step) in enumerate(zip(growers, steps)):
                grower.recent.clear()
                grower.stored = written.index(i if step.like is None else step.like)
            continue
        sums = _measure(here, steps, sizes, options)
        for i, (grower, step) in enumerate(zip(growers, steps)):
            if step.growing:
                grower.take([sums.get((i, node)) for node in range(step.nodes)])
    scored = _scored(here, _steps(growers), len(columns)) if score else None
    _forget(here)
    per_margin = 1 if options.columns_per_tree else 2
    return [Boosted(tuple(grower.trees), per_margin) for grower in growers], scored


def boost(rows: DataFrame, columns: Sequence[str], depth: int, options: ModelOptions) -> Boosted:
    """Grow ``max_iter`` trees on rows with the given columns and a label, 0 or 1."""
    return grow_all(rows, columns, [Fit(depth)], options)[0][0]


def grid_search(rows: DataFrame, columns: Sequence[str], options: ModelOptions, folds: int) -> tuple[list[float], Boosted, int]:
    """Mean AUC per depth over the folds, and the best depth's model of all rows; the first depth wins a tie.

    ``rows`` have the given columns, label and fold. All fits grow side by side; ``options.parallelism`` areas are
    computed at a time.
    """
    tasks = [Fit(depth, fold) for depth in options.max_depths for fold in range(folds)]
    refits = [Fit(depth) for depth in options.max_depths]
    models, scored = grow_all(rows, columns, [*tasks, *refits], options, score=True)

    def area(place: int) -> float:
        return roc_auc(scored.where(F.col("fold") == tasks[place].held), f"m{place}")

    with ThreadPoolExecutor(options.parallelism) as pool:
        areas = list(pool.map(inheritable_thread_target(rows.sparkSession)(area), range(len(tasks))))
    means = [math.fsum(areas[i * folds : (i + 1) * folds]) / folds for i in range(len(options.max_depths))]
    place = max(range(len(means)), key=lambda i: (means[i], -i))
    return means, models[len(tasks) + place], options.max_depths[place]
