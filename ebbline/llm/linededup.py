"""Line dedup that can be taken back: cuckoo filters over exact reference counts.

A line's key is the line stripped of white space, A-Z folded. An index keeps, in tables,

* ``postings``: which document (by doc_id) holds which key, keys as 128-bit hashes;
* ``refs``: per key the number of documents and the largest doc_id among them;
* ``filters``: per shard of keys one cuckoo filter, which holds the keys that at least ``min_docs``
  documents have.

Inserting documents raises counts, deleting documents lowers them, and keys that pass the threshold
either way enter or leave their shard's filter, so after a deletion lines come back. A key loses its
lines in all documents but the one with the largest doc_id. To find these lines, postings stream past
their shard's filter, which holds back all but the common keys and a few false ones; only what passes
is joined with the exact counts.

A line may be in a third of all documents. Counts are combined before they move; postings are dealt
out by shard and a salt, with as many salts as it takes for the shard's most common key to fill even shares, so
that only shards of very common keys have their filter copied; the exact join is left to the skew handling of
adaptive execution. The keys that a document loses are gathered for each of its texts by themselves where a
doc_id, or null, has several rows, so that no list of them is longer than a text.

Null and empty texts are one empty line. Null doc_ids are one document, smaller than all others, whatever
numbers these are. Repeated rows of a doc_id are one document, and each of them loses its lines. A doc_id that is
inserted again adds only keys it did not have. Empty tables are fine. Other columns pass unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbline.llm.arrow import each_group
from ebbline.llm.text import lower_ascii, packed, plain, stripped
from ebbline.session import stage

SLOTS = 4
MOST_KICKS = 200
# Filters are made for twice the keys they get, and made anew when they are fuller than this.
FULLEST = 0.9
KEY = ["d1", "d2"]
# A list of ids is broadcast while it is smaller than this; beyond, it is joined by a shuffle.
BROADCAST_BYTES = 32_000_000


class CuckooFilter:
    """16-bit fingerprints in buckets of four; what finds no bucket goes to an exact stash."""

    def __init__(self, table: np.ndarray, stash: list[tuple[int, int]]):
        self.table, self.stash = table, stash
        self.mask = len(table) - 1

    @classmethod
    def empty(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, math.ceil(math.log2(max(1, 2 * keys / SLOTS))))
        return cls(np.zeros((buckets, SLOTS), np.uint16), [])

    @classmethod
    def load(cls, packed_bytes: bytes) -> CuckooFilter:
        buckets, stashed = np.frombuffer(packed_bytes, np.int64, 2)
        table = np.frombuffer(packed_bytes, np.uint16, buckets * SLOTS, 16).reshape(buckets, SLOTS).copy()
        stash = np.frombuffer(packed_bytes, np.int64, stashed * 2, 16 + buckets * SLOTS * 2).reshape(-1, 2)
        return cls(table, [(int(a), int(b)) for a, b in stash])

    def dump(self) -> bytes:
        head = np.array([len(self.table), len(self.stash)], np.int64).tobytes()
        return head + self.table.tobytes() + np.array(self.stash, np.int64).tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of keys (the second halves of the hashes)."""
        bits = keys.astype(np.int64).view(np.uint64)
        marks = (bits >> np.uint64(48)).astype(np.int64)
        marks[marks == 0] = 1
        first = (bits & np.uint64(self.mask)).astype(np.int64)
        return marks, first, first ^ self.hop(marks)

    def hop(self, marks):
        return (marks * 0x5BD1E995 >> 7) & self.mask

    def insert(self, keys: np.ndarray) -> None:
        for mark, first, second in zip(*map(np.ndarray.tolist, self.places(keys))):
            self._insert(mark, first, second)

    def _insert(self, mark: int, first: int, second: int) -> None:
        for bucket in (first, second):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return
        bucket = second
        for kick in range(MOST_KICKS):
            slot = kick % SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket ^= int(self.hop(mark))
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return
        self.stash.append((mark, bucket))

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted; one copy of the fingerprint each."""
        for mark, first, second in zip(*map(np.ndarray.tolist, self.places(keys))):
            for bucket in (first, second):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break
            else:
                self.stash.remove(next(s for s in self.stash if s in ((mark, first), (mark, second))))

    def probe(self, keys: np.ndarray) -> np.ndarray:
        marks, first, second = self.places(keys)
        held = (self.table[first] == marks[:, None]).any(1) | (self.table[second] == marks[:, None]).any(1)
        for mark, bucket in self.stash:
            held |= (marks == mark) & ((first == bucket) | (second == bucket))
        return held

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table)) + len(self.stash)

    def room(self) -> float:
        return self.table.size * FULLEST


@dataclass(frozen=True)
class LineOptions:
    min_chars: int = 20
    min_docs: int = 3
    # Keys are dealt to so many filters; raise it so that a shard's common keys fit a task with ease.
    shards: int = 1024


def _id(column: str = "doc_id") -> Column:
    return F.col(column).cast("long").alias("id")


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equal columns, nulls among each other too."""
    equal = [left[name].eqNullSafe(right[name]) for name in names]
    return reduce(Column.__and__, equal)


def _lines(text: Column) -> Column:
    return F.split(plain(text), "\n")


def line_keys(docs: DataFrame, options: LineOptions) -> DataFrame:
    """Distinct (shard, d1, d2, id) of the lines that are long enough."""
    keys = F.transform(_lines(F.col("text")), lambda line: lower_ascii(stripped(line)))
    long_ones = F.array_distinct(F.filter(keys, lambda key: F.char_length(key) >= options.min_chars))
    each = docs.select(_id(), F.explode(long_ones).alias("key"))
    hashed = each.select(F.xxhash64("key").alias("d1"), F.xxhash64("key", F.lit(1)).alias("d2"), "id").distinct()
    return hashed.select(F.pmod("d1", F.lit(options.shards)).cast("int").alias("shard"), *KEY, "id")


FILTERS = "shard int, filter binary"


def _filter_row(shard, held: CuckooFilter | None) -> pa.Table:
    packed_filter = pa.array([held.dump() if held else None], pa.binary())
    return pa.table({"shard": pa.array([shard.as_py()], pa.int32()), "filter": packed_filter})


def _build(keys: pa.Table) -> pa.Table:
    """A filter that holds the common keys of one shard."""
    made = CuckooFilter.empty(keys.num_rows)
    made.insert(keys.column("d2").to_numpy())
    return _filter_row(keys.column("shard")[0], made)


def _update(rows: pa.Table) -> pa.Table:
    """A shard's filter after its changes; none where it would be too full, to be made anew.

    The old filter, if there is one, is the first row.
    """
    old, shard = rows.column("filter")[0], rows.column("shard")[0]
    changes = rows.slice(1) if old.is_valid else rows
    common, d2 = changes.column("common").to_numpy().astype(bool), changes.column("d2").to_numpy()
    enter, leave = d2[common], d2[~common]
    held = CuckooFilter.load(old.as_py()) if old.is_valid else CuckooFilter.empty(2 * len(enter))
    if len(held) + len(enter) - len(leave) > held.room():
        return _filter_row(shard, None)
    held.delete(leave)
    held.insert(enter)
    return _filter_row(shard, held)


def _by_shard(rows: DataFrame, *first: Column) -> DataFrame:
    """Shard by shard, each in one partition. A shard's common keys fit a task (``LineOptions.shards``)."""
    return rows.repartition("shard").sortWithinPartitions("shard", *first)


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted so that a shard's filter precedes its keys: the keys that the filter lets pass."""
    place, held = None, None
    for batch in batches:
        shards, salts = batch.column("shard").to_numpy(), batch.column("salt").to_numpy()
        d2, size = batch.column("d2").to_numpy(), batch.num_rows
        good = np.zeros(size, bool)
        starts = np.flatnonzero(np.diff(shards, prepend=-1) | np.diff(salts, prepend=-1)) if size else []
        starts = sorted({0, *map(int, starts)}) if size else []
        for start, end in zip(starts, [*starts[1:], size]):
            here = (int(shards[start]), int(salts[start]))
            if here != place:
                place, held = here, None
            if batch.column("filter")[start].is_valid:
                held, start = CuckooFilter.load(batch.column("filter")[start].as_py()), start + 1
            if held is not None and start < end:
                good[start:end] = held.probe(d2[start:end])
        kept = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in (*KEY, "id")], [*KEY, "id"])


@dataclass(frozen=True)
class LineIndex:
    """An index over some documents. Inserting and deleting give a new index; tables are never changed."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    options: LineOptions = LineOptions()

    @classmethod
    def empty(cls, spark: SparkSession, options: LineOptions = LineOptions()) -> LineIndex:
        return cls(
            spark.createDataFrame([], "shard int, d1 long, d2 long, id long"),
            spark.createDataFrame([], "shard int, d1 long, d2 long, n long, last long"),
            spark.createDataFrame([], FILTERS),
            options,
        )

    def insert(self, docs: DataFrame) -> LineIndex:
        keys = line_keys(docs, self.options)
        fresh = keys.join(self.postings, _same(keys, self.postings, *KEY, "id"), "left_anti")
        fresh = stage(fresh.select("shard", *KEY, "id"), "line-postings")
        added = self._counted(fresh)
        merged = self._beside(added).select(
            F.coalesce("shard", "new_shard").alias("shard"),
            *KEY,
            F.coalesce("n", F.lit(0)).alias("before"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("new_n", F.lit(0))).alias("n"),
            F.greatest("last", "new_last").alias("last"),
        )
        return self._with(self.postings.unionByName(fresh), merged)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Without the documents whose ids are in the column ``doc_id``."""
        gone = doc_ids.select(_id()).distinct()
        mine = _same(self.postings, gone, "id")
        kept = stage(self.postings.join(gone, mine, "left_anti").select("shard", *KEY, "id"), "line-postings")
        touched = self.postings.join(gone, mine, "left_semi").select(*KEY).distinct()
        again = self._counted(kept.join(touched, KEY, "left_semi")).unionByName(
            touched.selectExpr("CAST(NULL AS INT) AS shard", *KEY, "0L AS n", "CAST(NULL AS BIGINT) AS last")
        )
        again = again.groupBy(*KEY).agg(F.max("shard").alias("shard"), F.max("n").alias("n"), F.max("last").alias("last"))
        merged = self._beside(again).select(
            "shard",
            *KEY,
            F.col("n").alias("before"),
            F.coalesce("new_n", "n").alias("n"),
            F.when(F.col("new_n").isNull(), F.col("last")).otherwise(F.col("new_last")).alias("last"),
        )
        return self._with(kept, merged)

    @staticmethod
    def _counted(postings: DataFrame) -> DataFrame:
        return postings.groupBy("shard", *KEY).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))

    def _beside(self, changed: DataFrame) -> DataFrame:
        new = changed.select(*KEY, *[F.col(c).alias(f"new_{c}") for c in ("shard", "n", "last")])
        return self.refs.join(new, KEY, "full_outer")

    def _with(self, postings: DataFrame, merged: DataFrame) -> LineIndex:
        """The index over ``postings``, counts as in ``merged``; ``before`` there is the old count."""
        merged, least = stage(merged, "line-refs"), self.options.min_docs
        refs = merged.where("n > 0").drop("before")
        changes = merged.where((F.col("n") >= least) != (F.col("before") >= least)).select(
            "shard", "d2", (F.col("n") >= least).alias("common"), F.lit(None).cast("binary").alias("filter")
        )
        old = self.filters.select("shard", F.lit(0).cast("long").alias("d2"), F.lit(None).cast("boolean").alias("common"), "filter")
        both = _by_shard(old.unionByName(changes), F.col("filter").isNull())
        updated = stage(both.mapInArrow(each_group(_update, ["shard"]), FILTERS), "line-filters")
        full = updated.where("filter IS NULL").select("shard")
        renewed = refs.where(F.col("n") >= least).select("shard", "d2").join(full, "shard", "left_semi")
        renewed = stage(_by_shard(renewed).mapInArrow(each_group(_build, ["shard"]), FILTERS), "line-filters")
        return replace(
            self, postings=postings, refs=refs, filters=updated.where("filter IS NOT NULL").unionByName(renewed)
        )

    def dropped(self) -> DataFrame:
        """(id, d1, d2): the keys whose lines a document loses."""
        total = self.refs.agg(F.sum("n")).first()[0] or 1
        parts = int(self.postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # A row per shard: the size of the side broadcast here is fixed.
        salts = F.ceil(F.max("n") * F.lit(parts / total)).cast("int")
        salted = F.broadcast(self.refs.groupBy("shard").agg(F.least(F.lit(parts), F.greatest(F.lit(1), salts)).alias("salts")))
        keys = self.postings.join(salted, "shard").select(
            "shard", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), *KEY, "id",
            F.lit(None).cast("binary").alias("filter"),
        )
        zero = F.lit(0).cast("long")
        filters = self.filters.join(salted, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
            zero.alias("d1"), zero.alias("d2"), zero.alias("id"), "filter",
        )
        dealt = keys.unionByName(filters).repartition("shard", "salt")
        ordered = dealt.sortWithinPartitions("shard", "salt", F.col("filter").isNull())
        passed = ordered.mapInArrow(_passing, "d1 long, d2 long, id long")
        common = self.refs.where(F.col("n") >= self.options.min_docs).select(*KEY, "last")
        return passed.join(common, KEY).where(~F.col("id").eqNullSafe(F.col("last"))).select("id", *KEY)

    def _lost(self, docs: DataFrame, many: DataFrame) -> DataFrame:
        """(id, text_key, lost): what the document's texts lose; text_key is null where it has one text.

        Texts of an id in ``many`` are told apart by their hash, and lose only what they hold.
        """
        dropped = stage(self.dropped(), "line-dropped")
        alone = dropped.join(many, _same(dropped, many, "id"), "left_anti")
        alone = alone.groupBy("id").agg(F.collect_set("d1").alias("lost"))
        own = docs.select(_id(), "text")
        own = own.join(many, _same(own, many, "id"), "left_semi")
        hashes = F.transform(_lines(F.col("text")), lambda line: F.xxhash64(lower_ascii(stripped(line))))
        each = own.select("id", _text_key(), F.explode(F.array_distinct(hashes)).alias("d1"))
        held = each.join(dropped, _same(each, dropped, "id", "d1")).select(each["id"], "text_key", each["d1"])
        held = held.groupBy("id", "text_key").agg(F.collect_set("d1").alias("lost"))
        return alone.select("id", F.lit(None).cast("binary").alias("text_key"), "lost").unionByName(held)

    def rewrite(self, docs: DataFrame) -> DataFrame:
        """(row, n_lines, n_dropped, kept): each row of ``docs`` as a struct, and what is left of its text.

        Lines of one document are told apart by half of their hash, 64 bits.
        """
        many = docs.select(_id()).groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("id")
        many = stage(many, "line-many")
        many = F.broadcast(many) if many.count() * 8 <= BROADCAST_BYTES else many
        lost = self._lost(docs, many)
        rows = docs.select(packed(docs), _id(), plain(F.col("text")).alias("text"))
        several = many.withColumn("several", F.lit(True))
        rows = rows.join(several, _same(rows, several, "id"), "left").select(
            "row", rows["id"], "text", F.when(F.col("several"), _text_key()).alias("text_key")
        )
        joined = rows.join(lost, _same(rows, lost, "id", "text_key"), "left")
        joined = joined.select("row", "text", "lost", _lines(F.col("text")).alias("lines"))

        def stays(line: Column) -> Column:
            key = lower_ascii(stripped(line))
            return (F.char_length(key) < self.options.min_chars) | ~F.array_contains("lost", F.xxhash64(key))

        left = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.filter("lines", stays))
        counted = joined.select("row", "text", "lost", F.size("lines").cast("long").alias("n_lines"), left.alias("left"))
        return counted.select(
            "row",
            "n_lines",
            (F.col("n_lines") - F.size("left")).cast("long").alias("n_dropped"),
            F.when(F.col("lost").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("kept"),
        )


def _text_key() -> Column:
    return F.unhex(F.md5(plain(F.col("text")))).alias("text_key")


def dedup_lines(docs: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """(row, n_lines, n_dropped, kept) of all documents, from an index over all of them."""
    return LineIndex.empty(docs.sparkSession, options).insert(docs).rewrite(docs)
