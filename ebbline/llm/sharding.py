"""Sharding by jump consistent hashing, with gapless slots inside every shard.

A key walks through a fixed sequence of jumps: a 64-bit linear congruential generator seeded with the
key gives the next shard it would move to as shards are appended. Its shard among ``n`` is the last
jump below ``n``, so there is no ring or table to keep, and one more shard takes rows only into
itself: those whose next jump is exactly ``n``. Everything is column arithmetic. The generator's
64-bit product is put together from 16- and 32-bit parts, because a plain BIGINT product overflows.

Null keys count as key 0. Texts that are null or empty have no bytes and checksum 0. Repeated rows
are rows of their own and get different slots of the same shard, and rows that tie in all they are ordered by
get them in any order. Texts may be of any length. An empty table gives no rows. ``shard_documents`` looks at no
other columns; ``with_shards`` and ``with_slots`` need the names shard, grown_shard and slot, and names that begin
with an underscore, for themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbline.llm.text import plain
from ebbline.session import stage

# Fixed value: the multiplier of the generator.
MULTIPLIER = 2862933555777941757
LOW_32 = 0xFFFFFFFF
# Jumps looked at in one go; keys that are done skip the other blocks.
BLOCK = 16


def _jump(state: str, shards: int) -> str:
    """One turn of the generator and the jump it leads to; ``state`` has hi, lo, last and next."""
    high, low = MULTIPLIER >> 32, MULTIPLIER & LOW_32
    low_1, low_0 = low >> 16, low & 0xFFFF
    wide = f"({state}.lo * {low_0}L + shiftleft({state}.lo * {low_1}L & 65535L, 16) + 1L)"
    new_lo = f"({wide} & {LOW_32}L)"
    new_hi = (
        f"((shiftright({wide}, 32) + shiftright({state}.lo * {low_1}L, 16) + {state}.hi * {low_0}L"
        f" + shiftleft({state}.hi * {low_1}L & 65535L, 16) + {state}.lo * {high}L) & {LOW_32}L)"
    )
    return (
        f"IF({state}.next >= {shards}L, {state}, named_struct('hi', {new_hi}, 'lo', {new_lo}, 'last', {state}.next,"
        f" 'next', CAST(floor(({state}.next + 1) * (2147483648D / (shiftright({new_hi}, 1) + 1))) AS BIGINT)))"
    )


def jumps(key: str, shards: int) -> Column:
    """Struct of ``last``, the shard among ``shards``, and ``next``, the shard count at which it moves."""
    seed = f"coalesce(CAST({key} AS BIGINT), 0L)"
    start = (
        f"named_struct('hi', shiftrightunsigned({seed}, 32), 'lo', {seed} & {LOW_32}L, 'last', -1L, 'next', 0L)"
    )
    block = f"aggregate(sequence(1, {BLOCK}), s, (u, y) -> {_jump('u', shards)})"
    # A key makes at most one jump to each shard, so this many turns always suffice.
    blocks = math.ceil(shards / BLOCK)
    return F.expr(f"aggregate(sequence(1, {blocks}), {start}, (s, x) -> IF(s.next >= {shards}L, s, {block}))")


def with_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``shard`` among ``shards`` and ``grown_shard`` among one more."""
    moved = df.withColumn("_jumps", jumps(key, shards))
    return moved.select(
        *df.columns,
        F.col("_jumps.last").cast("int").alias("shard"),
        F.when(F.col("_jumps.next") == shards, F.lit(shards))
        .otherwise(F.col("_jumps.last"))
        .cast("int")
        .alias("grown_shard"),
    )


def with_slots(df: DataFrame, group: str, order: list[str], rows_per_part: int = 1_000_000) -> DataFrame:
    """Add ``slot``: gapless from 0 within ``group``, in the order of ``order``.

    No task holds a whole group. Rows are dealt out by ranges of (group, order), the ranges' row
    counts are added up per group, and rows are numbered inside their range. Rows that agree in all
    of ``order`` are told apart by where they were read, so copies can be split over ranges as well.
    """
    rows = stage(df.withColumn("_read", F.monotonically_increasing_id()), "slots")
    session = df.sparkSession
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / rows_per_part))
    keys = [*order, "_read"]
    dealt = stage(
        rows.repartitionByRange(parts, group, *keys).withColumn("_part", F.spark_partition_id()), "slots-dealt"
    )
    counts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*keys))
    numbered = dealt.withColumn("_place", place).join(offsets, [group, "_part"])
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place") - 1).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Sizes, checksums, shards and slots of documents, under the law ``key``."""
    text = plain(F.col("text"))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = with_slots(with_shards(sized, "doc_id", shards), "shard", ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
