"""Near-duplicate documents by SimHash fingerprints, compared bit-sliced.

A document's fingerprint has a bit set where more than half of the XXH64 hashes of its three-word shingles,
repeats included, have it. Documents link where fingerprints differ in at most ``radius`` bits.

1. Documents with equal fingerprints form a class; only distinct fingerprints are compared.
2. Keys. The 64 bits are cut into radius + 2 pieces. Fingerprints that differ in at most ``radius`` bits have
   two equal pieces at least, so each pair of pieces is a key and no link is lost.
3. Groups of one key are cut into blocks of at most ``BLOCK`` fingerprints or so, and a task has one block or
   two. A block is stored vertically: bit p of 64 fingerprints is one word. A difference in plane p updates
   64 distances with a carry-save counter of a few words, which starts so that it runs over when the radius
   is passed; words in which every counter has run over are abandoned, most of them after a third of the
   planes. Small groups are laid end to end and compared with themselves, shifted by 1, 2, 3, ... places.
4. A task hands on one edge per fingerprint that is not the first of its component there, never all pairs.
   Components of the edges give the smallest doc_id.

Texts with fewer words than a shingle are one shingle. Those without words, null ones included, have the
fingerprint zero and are linked like any other. Repeated rows share a fingerprint. Null doc_ids are never a
component's id unless it has no other: then that is null. Texts of any length are hashed in parts. Tables may
be empty; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ebbline.llm.arrow import slices
from ebbline.llm.components import components
from ebbline.session import stage

BITS = 64
SEED = 42
# Fingerprints of a hot key that meet in one task, per block.
BLOCK = 16_384
# Groups up to this size are compared many at a time.
SMALL = 64
# Fingerprints that are compared with a block at once, and planes between looks at what is abandoned.
QUERIES = 32
PLANES = 8
# Hashes that are counted at a time, and rows of small groups that are compared at a time.
HASHES_AT_ONCE = 65_536
ROWS_AT_ONCE = 65_536
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by a space; of all words where there are fewer."""
    # Bytes fold and split by ASCII rules alone.
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    ends = (starts + lengths - 1)[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[start : start + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, size: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, fp): fingerprints as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                found = np.array([fingerprint(shingle_hashes(t or b"", size)) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


def piece_keys(radius: int) -> Column:
    """An array with one key per pair of pieces: which pair, and the two pieces' bits."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    keys = []
    for number, pair in enumerate(combinations(range(radius + 2), 2)):
        mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in pair)
        signed = mask - (1 << BITS) if mask >> BITS - 1 else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed).cast("long"))))
    return F.array(*keys)


def vertical(fps: np.ndarray) -> np.ndarray:
    """Bit planes by words of 64 fingerprints; the last word is filled up with zeros."""
    padded = np.zeros(-(-len(fps) // BITS) * BITS, np.uint64)
    padded[: len(fps)] = fps
    cells = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(cells.T, axis=1, bitorder="little")).view("<u8")


class Counter:
    """Distances of 64 fingerprints per word, as bits of equal weight in words of their own.

    It starts at the number that lets it run over when ``radius`` is passed.
    """

    def __init__(self, shape: tuple[int, ...], radius: int) -> None:
        weights = radius.bit_length()
        start = (1 << weights) - 1 - radius
        self.digits = [np.full(shape, ALL if start >> k & 1 else 0, np.uint64) for k in range(weights)]
        self.over = np.zeros(shape, np.uint64)

    def add(self, carry: np.ndarray) -> None:
        for digit in self.digits:
            following = digit & carry
            digit ^= carry
            carry = following
        self.over |= carry

    def keep(self, places: np.ndarray) -> None:
        self.digits = [digit[places] for digit in self.digits]
        self.over = self.over[places]


def within(difference: Callable[[int, np.ndarray], np.ndarray], words: int, radius: int) -> np.ndarray:
    """Per word the bits of the pairs that differ in at most ``radius`` planes.

    ``difference(p, places)`` gives plane p's differences at those places of the words.
    """
    near = np.zeros(words, np.uint64)
    places = np.arange(words)
    counter = Counter((words,), radius)
    for start in range(0, BITS, PLANES):
        for plane in range(start, start + PLANES):
            counter.add(difference(plane, places))
        alive = counter.over != ALL
        if not alive.all():
            places = places[alive]
            counter.keep(alive)
        if not len(places):
            return near
    near[places] = ~counter.over
    return near


def _bits(words: np.ndarray, count: int) -> np.ndarray:
    """Words as booleans, the first ``count`` of them along the last axis."""
    cells = np.unpackbits(np.ascontiguousarray(words).astype("<u8").view(np.uint8), axis=-1, bitorder="little")
    return cells[..., :count].astype(bool)


def joined_small(keys: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Per row the first row of its component within its group; groups are of at most ``SMALL`` rows, end to end."""
    rows, label = len(fps), np.arange(len(fps))
    planes = vertical(fps)
    following = np.concatenate([planes[:, 1:], np.zeros((BITS, 1), np.uint64)], axis=1)
    left, right = [], []
    for shift in range(1, SMALL):
        same = np.zeros(planes.shape[1] * BITS, np.uint8)
        same[: max(0, rows - shift)] = keys[shift:] == keys[: rows - shift]
        if not same.any():
            break
        wanted = np.packbits(same, bitorder="little").view("<u8")
        places = np.flatnonzero(wanted)

        def difference(plane: int, at: np.ndarray, places=places, shift=shift) -> np.ndarray:
            here, after = planes[plane, places[at]], following[plane, places[at]]
            return here ^ (here >> np.uint64(shift) | after << np.uint64(BITS - shift))

        near = np.zeros(len(wanted), np.uint64)
        near[places] = within(difference, len(places), radius)
        first = np.flatnonzero(_bits(near & wanted, rows))
        left.append(first)
        right.append(first + shift)
    if left:
        u, v = np.concatenate(left), np.concatenate(right)
        while len(u):
            low = np.minimum(label[u], label[v])
            before = label.copy()
            np.minimum.at(label, u, low)
            np.minimum.at(label, v, low)
            label = label[label]
            if (label == before).all():
                break
    return label


def joined_blocks(queries: np.ndarray, fps: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Labels of the queries and then of ``fps``: equal for those that links between the two join.

    With ``same`` the two are one block, whose labels are given once.
    """
    label = np.arange(len(fps) if same else len(queries) + len(fps))
    shift = 0 if same else len(queries)
    planes = vertical(fps)
    words = planes.shape[1]
    start, step = 0, 1
    while start < len(queries):
        part = queries[start : start + step]
        masks = [np.where(part >> np.uint64(p) & np.uint64(1), ALL, np.uint64(0)) for p in range(BITS)]

        def difference(plane: int, at: np.ndarray, masks=masks) -> np.ndarray:
            return planes[plane, at % words] ^ masks[plane][at // words]

        near = _bits(within(difference, len(part) * words, radius).reshape(len(part), words), len(fps))
        for number, hits in enumerate(near, start):
            found = label[shift:][hits]
            others = np.unique(found[found != label[number]])
            if len(others):
                label[np.isin(label, others)] = label[number]
        # A first query that is linked with most spares the others their relabelling.
        start, step = start + len(part), min(2 * step, QUERIES)
    return label


def _edges(radius: int) -> Callable:
    """For ``mapInArrow``: rows sorted by (key, i, j) to edges (u, v) that join what links join."""

    def of_large(fps: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = own == own.min()
        rows = np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
        fps = fps[rows]
        if first.all():
            label = joined_blocks(fps, fps, radius, same=True)
        else:
            label = joined_blocks(fps[: first.sum()], fps[first.sum() :], radius, same=False)
        _, at, inverse = np.unique(label, return_index=True, return_inverse=True)
        return fps, fps[at[inverse]]

    def of_small(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return fps, fps[joined_small(keys, fps, radius)]

    def table(ends: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        apart = ends[0] != ends[1]
        return pa.RecordBatch.from_arrays([pa.array(end[apart].view(np.int64)) for end in ends], ["u", "v"])

    def groups(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Edges of whole groups."""
        key, i, j, own, fps = columns
        changes = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.concatenate([[0], np.flatnonzero(changes) + 1])
        sizes = np.diff(np.append(starts, len(key)))
        numbers = np.repeat(np.arange(len(starts)), sizes)
        small = (sizes <= SMALL) & (i[starts] == j[starts])
        rows = np.flatnonzero(small[numbers])
        for start in _cuts(numbers[rows]):
            yield table(of_small(numbers[rows][start], fps[rows][start]))
        for at in np.flatnonzero(~small):
            part = slice(starts[at], starts[at] + sizes[at])
            yield table(of_large(fps[part], own[part]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "own", "fp")]
            columns[-1] = columns[-1].view(np.uint64)
            held.append(columns)
            last = [c[-1] for c in columns[:3]]
            if sum(len(c[0]) for c in held) < ROWS_AT_ONCE:
                continue
            whole = [np.concatenate(parts) for parts in zip(*held)]
            # The last group may go on in the next batch.
            done = np.flatnonzero((whole[0] != last[0]) | (whole[1] != last[1]) | (whole[2] != last[2]))
            cut = done[-1] + 1 if len(done) else 0
            held = [[c[cut:] for c in whole]]
            if cut:
                yield from groups([c[:cut] for c in whole])
        if held:
            yield from groups([np.concatenate(parts) for parts in zip(*held)])

    return run


def _cuts(numbers: np.ndarray) -> Iterator[slice]:
    """Parts of about ``ROWS_AT_ONCE`` rows that end with a group."""
    start = 0
    while start < len(numbers):
        end = min(start + ROWS_AT_ONCE, len(numbers))
        if end < len(numbers):
            end = int(np.searchsorted(numbers, numbers[end - 1], side="right"))
        yield slice(start, end)
        start = end


def find_links(distinct: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) whose components are those of all links between the fingerprints ``fp``."""
    keyed = distinct.select("fp", F.explode(piece_keys(radius)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = keyed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("m") / block))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks"))
    # A fingerprint meets each block once: as the first of the two if its own comes first.
    meets = F.expr("transform(sequence(0L, blocks - 1), o -> struct(least(own, o) AS i, greatest(own, o) AS j))")
    dealt = met.select("key", "fp", "blocks", own.alias("own")).select("key", "fp", "own", F.explode(meets).alias("part"))
    part = ["key", "i", "j"]
    rows = dealt.select("key", "part.i", "part.j", "own", "fp").repartition(*part).sortWithinPartitions(*part)
    return rows.mapInArrow(_edges(radius), "u long, v long")


def label_documents(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: its fingerprint in hex and the smallest doc_id of its component."""
    drawn = stage(with_fingerprints(docs, size), "simhash")
    distinct = stage(drawn.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    found = components(stage(find_links(distinct.select("fp"), radius), "simhash-links"))
    placed = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.withColumn("component", F.coalesce("component", "fp"))
    lows = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = placed.join(lows, "component").select("fp", "component_id")
    return drawn.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
