"""Near-duplicate documents by HyperMinHash sketches, confirmed on full shingle sets.

A document's set holds the 64-bit hashes of its distinct word shingles. One pass over the set fills
128 registers: the top bits of a hash choose the bucket, and of the smallest rest in a bucket the
register keeps the number of leading zeros and ten mantissa bits, 16 bits in all.

1. Documents with equal sets form a class; only classes are compared. A hot group of copies is one.
2. Banding. A key hashes four registers that follow each other among the buckets in use, on a circle.
   Well-filled sketches start a key at every fourth bucket; sketches with empty buckets at every bucket
   in use, so that a few very common shingles alone never make a key. Two full sketches of a similarity
   of 0.8 share no such key with probability 5e-8. In sets of few shingles one collision of buckets
   weighs more, so sets of up to ``EXACT`` shingles have exact keys besides: with shingles in one order,
   those of the fewest sets first, near sets share one of their first n - ceil(0.8 n) + 1.
3. Links. Within a key every class is paired with one only, the class that meets most others over all
   keys: linear in the key, and likely to be the original of a family of copies. Pairs whose estimated
   similarity, corrected for chance collisions of registers, is more than six standard errors too low
   are left out. The others are confirmed on the full sets.
4. Components of these links. Classes that met the same partner but are in different components so far
   are tested against each other too, so no link is lost. Their group is cut into blocks of at most ``BLOCK`` or
   so, a task has one or two: first the sketches, then the full sets of those that the sketches leave in doubt.
   Members of groups of more than ``BLOCKS`` blocks meet by exact keys instead: one of two near sets that is not the larger has a shingle among its first
   n - ceil(8/9 n) + 1 which the other has among its first n - ceil(0.8 n) + 1, when those that many of them have
   come last. Texts around a common passage that are alike, but not near, share none, so that a family of them is
   no more work than as many other texts.
   Keys that still bring components together are compared in blocks, keys of the same sets once. A task hands on
   as many links as join its components, never all pairs.

Texts with fewer words than a shingle are one shingle; those without words, null ones included, are
linked with nothing. Repeated rows belong to one class. Null doc_ids come last: a component's id is
null only if all its documents' are. Tables may be empty; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ebbline.llm.arrow import each_group, map_arrow, slices
from ebbline.llm.components import components
from ebbline.llm.simhash import shingle_hashes
from ebbline.llm.text import packed
from ebbline.session import stage

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND = 4
# Sketches with at most this many buckets in use start a key at each of them.
SPARSE = 96
# Links of sets with at most this many shingles are found by exact keys.
EXACT = 64
BLOCK = 1024
# Blocks of a group that are compared with each other; members of larger groups meet by exact keys.
BLOCKS = 4
# Shingles of large groups that are known to be common, at eight bytes each in every task.
COMMON = 500_000
STANDARD_ERRORS = 6.0
# Fixed value of the published estimator: expected collisions of registers between disjoint sets.
COLLISION = 0.169919487159739093975315012348
# Bounds on what a task holds: text that is hashed at a time, and while it compares two blocks, pairs of
# sketches and columns of shingles.
SLICE_BYTES = 2_000_000
PAIRS_AT_ONCE = 8192
COLUMNS_AT_ONCE = 8192
# A list of row numbers is broadcast while it is smaller than this; beyond, it is joined by a shuffle.
BROADCAST_BYTES = 32_000_000
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of every text."""
    return [np.unique(shingle_hashes(text or b"", size)) for text in texts.cast(pa.binary()).to_pylist()]


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))


def with_shingles(texts: DataFrame, size: int) -> DataFrame:
    """(node, hashes) from (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                hashes = _lists(_sets(batch.column("text"), size))
                yield pa.RecordBatch.from_arrays([batch.column("node"), hashes], ["node", "hashes"])

    return map_arrow(texts.select("node", "text"), run, "node long, hashes array<long>")


def prefix_keys(texts: DataFrame, common: np.ndarray, size: int, percent: int) -> DataFrame:
    """(part, node, component, first) from (node, component, text): shingles by which near sets meet.

    Of two near sets both have one of the parts, and the one that is not the larger has it with ``first``. That
    holds for any one order of all shingles; here those in ``common``, sorted, come last.
    """
    sent = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                keys, sizes, firsts = [], [], []
                for hashes in _sets(batch.column("text"), size):
                    n = len(hashes)
                    places = n - -(-percent * n // 100) + 1 if n else 0
                    last = np.isin(hashes, sent.value, assume_unique=True)
                    keys.append(np.concatenate([hashes[~last], hashes[last]])[:places])
                    sizes.append(places)
                    firsts.append(np.arange(places) < n - -(-2 * percent * n // (100 + percent)) + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)),
                        pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                        pa.array(np.repeat(batch.column("component").to_numpy(), sizes)),
                        pa.array(np.concatenate([*firsts, np.zeros(0, bool)])),
                    ],
                    ["part", "node", "component", "first"],
                )

    return map_arrow(texts.select("node", "component", "text"), run, "part long, node long, component long, first boolean")


def registers(hashes: np.ndarray, owners: np.ndarray, rows: int) -> np.ndarray:
    """A row of 16-bit registers per owner; 0 is an empty bucket."""
    lowest = np.full(rows * BUCKETS, EMPTY)
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    np.minimum.at(lowest, owners * BUCKETS + bucket, hashes << np.uint64(BUCKET_BITS))
    used = lowest != EMPTY
    # A double's exponent gives the leading zeros, its fraction the bits after the leading one.
    fraction, exponent = np.frexp(np.maximum(lowest, np.uint64(1)).astype(np.float64))
    zeros = np.minimum(64 - exponent, 62)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    packed_bits = (zeros.astype(np.int64) << MANTISSA_BITS | mantissa) + 1
    return np.where(used, packed_bits, 0).astype(np.uint16).reshape(rows, BUCKETS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """Keys of one sketch: hashes of ``BAND`` registers in a row among those in use."""
    used = np.flatnonzero(sketch)
    if not len(used):
        return np.zeros(0, np.int64)
    if len(used) <= SPARSE:
        first = np.arange(len(used))
    else:
        first = np.searchsorted(used, np.arange(0, BUCKETS, BAND)) % len(used)
    cells = used.astype(np.uint64) << np.uint64(16) | sketch[used].astype(np.uint64)
    key = np.zeros(len(first), np.uint64)
    for step in range(min(BAND, len(used))):
        key = (key ^ cells[(first + step) % len(used)]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return np.unique(key).view(np.int64)


def sketches(texts: DataFrame, size: int) -> DataFrame:
    """(node, id, n, d1, d2, registers, keys) from (node, id, text); d1 and d2 tell sets apart."""
    schema = T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("id", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("d1", T.LongType()),
            T.StructField("d2", T.LongType()),
            T.StructField("registers", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def drawn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(batch.column("text"), size)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        hashes = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owners = np.repeat(np.arange(len(sizes)), sizes)
        regs = registers(hashes, owners, len(sizes))
        mixed = (hashes ^ hashes >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(27)
        sums = []
        for values in (hashes, mixed):
            total = np.zeros(len(sizes), np.uint64)
            np.add.at(total, owners, values)
            sums.append(pa.array(total.view(np.int64)))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                batch.column("id"),
                pa.array(sizes, pa.int64()),
                *sums,
                pa.array([row.tobytes() for row in regs], pa.binary()),
                pa.array([band_keys(row) for row in regs], pa.list_(pa.int64())),
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                yield drawn(batch)

    return map_arrow(texts.select("node", "id", "text"), run, schema)


def estimated(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple:
    """Similarity of sketches, corrected for chance collisions, and the number of buckets it rests on."""
    used = ((left > 0) | (right > 0)).sum(axis=1)
    equal = ((left == right) & (left > 0)).sum(axis=1)
    ratio = n_left / n_right
    chance = COLLISION * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(equal - chance, 0) / np.maximum(used - chance, 1), used


def _near(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, least: float) -> np.ndarray:
    """Whether the estimate is at most six standard errors below ``least``."""
    share, used = estimated(left, right, n_left, n_right)
    return share >= least - STANDARD_ERRORS * np.sqrt(least * (1 - least) / np.maximum(used, 1))


def _likely(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose sizes allow ``least`` and whose estimate is not far below it."""
    sized = classes.select("node", "n", "registers")
    left = sized.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = sized.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    sides = pairs.join(left, "a").join(right, "b")
    sides = sides.where(F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(least - 1e-9))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            both = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb")
            ]
            sizes = [batch.column(c).to_numpy() for c in ("na", "nb")]
            good = pa.array(_near(*both, *sizes, least))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])

    return map_arrow(sides, run, "a long, b long")


def _listed(rows: DataFrame) -> DataFrame:
    """Rows of longs, with a broadcast hint if their counted size is small."""
    return F.broadcast(rows) if rows.count() * 8 * len(rows.columns) <= BROADCAST_BYTES else rows


def _exact_keys(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, key) of small classes; any two that are near share a key.

    The larger of two near sets may have more than ``EXACT`` shingles and has keys too. Sets so small that
    only equal ones are near have none.
    """
    few = classes.where(F.expr(f"n <= {EXACT * 100 // percent} AND n * {100 - percent} >= {percent}")).select("node")
    sets = stage(with_shingles(texts.join(_listed(few), "node", "left_semi"), size), "neardup-few")
    each = sets.select("node", F.explode("hashes").alias("shingle"), F.size("hashes").alias("n"))
    # Shingles of one class alone come first in the order but meet nothing; the others take the places left.
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    ordered = F.array_sort(F.collect_list(F.struct("m", "shingle"))).alias("common")
    common = each.join(counts, "shingle").groupBy("node", "n").agg(ordered)
    places = f"CAST(greatest(0, size(common) - (n * {percent} + 99) div 100 + 1) AS INT)"
    first = common.select("node", F.explode(F.expr(f"slice(common, 1, {places})")).alias("first"))
    return first.select("node", F.xxhash64("first.shingle").alias("key"))


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    sets = with_shingles(texts.join(_listed(wanted), "node", "left_semi"), size)
    # The larger share of the rows meets its sets first; the common partner is joined with them last.
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - F.col("shared")
    return (
        both.withColumn("shared", shared)
        .where(100 * F.col("shared") >= percent * union)
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


PART = ["part", "i", "j"]


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of two blocks next to each other; a pair of blocks is never more than 2 * BLOCK rows or so."""
    return rows.repartition(*PART).sortWithinPartitions(*PART)


def _doubtful(least: float):
    """Classes of two blocks whose sketches do not rule out a link into another component."""

    def run(block: pa.Table) -> pa.Table:
        regs = np.frombuffer(b"".join(block.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        n = block.column("n").to_numpy()
        left, right = np.nonzero(_crossing(block))
        fits = np.minimum(n[left], n[right]) >= (least - 1e-9) * np.maximum(n[left], n[right])
        left, right = left[fits], right[fits]
        wanted = np.zeros(len(n), bool)
        for at in range(0, len(left), PAIRS_AT_ONCE):
            a, b = left[at : at + PAIRS_AT_ONCE], right[at : at + PAIRS_AT_ONCE]
            good = _near(regs[a], regs[b], n[a], n[b], least)
            wanted[a[good]] = wanted[b[good]] = True
        return block.select([*PART, "node", "component", "own"]).filter(pa.array(wanted))

    return run


def _crossing(block: pa.Table) -> np.ndarray:
    """Upper triangle of the pairs to test: different components and, for two blocks, different blocks."""
    component, own = block.column("component").to_numpy(), block.column("own").to_numpy()
    pairs = np.triu(component[:, None] != component[None, :], 1)
    if block.num_rows and block.column("i")[0].as_py() != block.column("j")[0].as_py():
        pairs &= own[:, None] != own[None, :]
    return pairs


def _joining(percent: int):
    """Confirmed links of two blocks, as many as it takes to join the components they join."""

    def run(block: pa.Table) -> pa.Table:
        lists = block.column("hashes").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        owners = np.repeat(np.arange(len(sizes)), sizes)
        hashes, place = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        # Shingles of a single class cannot be shared. The others become columns, some at a time.
        shared = np.bincount(place, minlength=len(hashes)) > 1
        column = (np.cumsum(shared) - 1)[place]
        usable = shared[place]
        owners, column = owners[usable], column[usable]
        order = np.argsort(column, kind="stable")
        owners, column = owners[order], column[order]
        both = np.zeros((len(sizes), len(sizes)), np.float32)
        for first in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
            start, end = np.searchsorted(column, [first, first + COLUMNS_AT_ONCE])
            held = np.zeros((len(sizes), COLUMNS_AT_ONCE), np.float32)
            held[owners[start:end], column[start:end] - first] = 1
            both += held @ held.T
        union = sizes[:, None] + sizes[None, :] - both
        linked = _crossing(block) & (100 * both >= percent * union)
        node, component = block.column("node").to_numpy(), block.column("component").to_numpy()
        root = {c: c for c in component.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        links = []
        for a, b in np.argwhere(linked).tolist():
            one, other = find(int(component[a])), find(int(component[b]))
            if one != other:
                root[one] = other
                links.append((int(node[a]), int(node[b])))
        ends = list(zip(*links)) or [(), ()]
        return pa.table({"u": pa.array(ends[0], pa.int64()), "v": pa.array(ends[1], pa.int64())})

    return run


def _across(
    met: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between classes that met the same partner (a, b: partner) but are in different components."""
    dealt = _dealt(met, found, texts, size, percent)
    sketched = dealt.join(classes.select("node", "n", "registers"), "node")
    kind = "part long, i long, j long, node long, component long, own long"
    doubtful = stage(map_arrow(_in_blocks(sketched), each_group(_doubtful(percent / 100), PART), kind), "neardup-doubtful")
    wanted = stage(doubtful.select("node").distinct(), "neardup-wanted")
    sets = with_shingles(texts.join(_listed(wanted), "node", "left_semi"), size)
    return map_arrow(_in_blocks(doubtful.join(sets, "node")), each_group(_joining(percent), PART), "u long, v long")


def _dealt(met: DataFrame, found: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows of blocks to be compared: part, i and j name a block or a pair of blocks, ``own`` the row's block."""
    placed = met.join(found, F.col("a") == F.col("node"), "left").select(
        F.col("b").alias("part"), F.col("a").alias("node"), F.coalesce("component", "a").alias("component")
    )
    placed = stage(placed, "neardup-placed")
    mixed = _mixed(placed)
    blocks = F.ceil(F.col("m") / BLOCK).alias("blocks")
    small = placed.join(mixed.where(F.col("m") <= BLOCK * BLOCKS).select("part", blocks), "part")
    asked = placed.join(mixed.where(F.col("m") > BLOCK * BLOCKS), "part", "left_semi").select("node", "component").distinct()
    asked = stage(asked, "neardup-asked")
    # Their texts once, beside the rows of one list: what is asked for is a fraction of all.
    sets = stage(texts.select("node", "text").join(_listed(asked), "node"), "neardup-asked-texts")
    keyed = stage(prefix_keys(sets, _common(sets, size), size, percent), "neardup-keyed")
    members = F.struct(F.bit_xor(F.xxhash64("node")), F.sum(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 40)))).alias("members")
    sized = _mixed(keyed, F.bool_or("first").alias("first"), members).where("first").dropDuplicates(["m", "members"])
    large = keyed.drop("first").join(sized.select("part", blocks), "part")
    rows = small.unionByName(large).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    # A class meets each block once: as the first of the two if its own comes first.
    meets = F.expr("transform(sequence(0L, blocks - 1), o -> struct(least(own, o) AS i, greatest(own, o) AS j))")
    met_blocks = rows.select("part", "node", "component", "own", F.explode(meets).alias("block"))
    return met_blocks.select("part", "node", "component", "own", "block.i", "block.j")


def _common(texts: DataFrame, size: int) -> np.ndarray:
    """The shingles that most of the texts have, at most ``COMMON`` of those that more than a block of texts have."""
    each = with_shingles(texts, size).select(F.explode("hashes").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK)
    found = counts.orderBy(F.desc("m"), "shingle").limit(COMMON).select("shingle").toArrow()
    return np.sort(found.column("shingle").to_numpy().view(np.uint64))


def _mixed(rows: DataFrame, *more) -> DataFrame:
    """Parts whose rows are not all of one component, with the number of their rows."""
    ends = [F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("m")]
    return rows.groupBy("part").agg(*ends, *more).where("low < high").drop("low", "high")


def find_components(
    docs: DataFrame, size: int = 5, percent: int = 80, carry: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows as read (node, id, text), and (node, id, n, component_id, keeper) for every row.

    ``keeper`` is the number of the one row that stands for the component. With ``carry`` the rows as
    read also hold all columns of ``docs`` as the struct ``row``.
    """
    least = percent / 100
    read = docs.select(
        F.monotonically_increasing_id().alias("node"),
        packed(docs) if carry else F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("id"),
    )
    texts = stage(read, "neardup-texts")
    if carry:
        # The text is in the row already and is not written twice.
        texts = texts.withColumn("text", F.col("row.text").cast("string"))
    drawn = stage(sketches(texts, size), "neardup-sketches")
    # Classes are told apart by 128 bits and the set's size.
    classes = stage(
        drawn.where("n > 0")
        .groupBy("d1", "d2", "n")
        .agg(
            F.min("node").alias("node"),
            # Null ids come last.
            F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "node")).alias("keeper"),
            F.any_value("registers").alias("registers"),
            F.any_value("keys").alias("keys"),
        ),
        "neardup-classes",
    )
    exact = stage(_exact_keys(classes, texts, size, percent), "neardup-exact")
    keyed = classes.select("node", F.explode("keys").alias("key")).unionByName(exact)
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stage(keyed.join(shared, "key"), "neardup-members")
    meeting = members.groupBy("node").agg(F.sum("m").alias("met"))
    ranked = members.join(meeting, "node").select("key", F.struct("met", "node").alias("rank"))
    first = ranked.groupBy("key").agg(F.max("rank").alias("first"))
    pairs = ranked.join(first, "key").select(F.col("rank.node").alias("a"), F.col("first.node").alias("b"))
    met = stage(pairs.where("a <> b").distinct(), "neardup-met")
    likely = stage(_likely(met, classes, least), "neardup-likely")
    links = stage(_confirmed(likely, texts, size, percent), "neardup-links")
    found = stage(components(links), "neardup-found")
    more = stage(_across(met, found, classes, texts, size, percent), "neardup-more")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    grouped = classes.select("d1", "d2", "n", "node", "keeper").join(found, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    keepers = grouped.groupBy("component").agg(F.min("keeper").alias("best"))
    named = grouped.join(keepers, "component").select("d1", "d2", "n", "best")
    out = drawn.select("node", "id", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
    return texts, out.select(
        "node",
        "id",
        "n",
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component_id"),
        F.coalesce("best.node", "node").alias("keeper"),
    )


def label_documents(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """One row per document: the size of its set, its component and whether it is the one kept."""
    _, found = find_components(docs.select("doc_id", "text"), size, percent)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns unchanged, without those whose component another row stands for."""
    texts, found = find_components(docs, size, percent, carry=True)
    gone = stage(found.where("node <> keeper").select("node"), "neardup-gone")
    return texts.join(_listed(gone), "node", "left_anti").select("row.*")
