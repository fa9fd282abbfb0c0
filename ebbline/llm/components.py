"""Connected components of an edge table, by alternating large and small stars.

Every round points nodes at the smallest neighbour seen from them; it ends when no edge changes. The
rounds' edges are written to the shared folder, so no lineage grows and a lost executor costs a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ebbline.session import stage


def _smallest(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with ``low``, the smallest of u and all its v. Combined before the shuffle."""
    low = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return pairs.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _smallest(down)
    ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v"))))
    return found.select(ends.alias("e")).select("e.u", "e.v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node."""
    clean = edges.select("u", "v").where("u <> v").distinct()
    current, before = stage(clean, "edges"), None
    while True:
        after = _small_star(_large_star(current)).where("u <> v").distinct()
        current = stage(after, "edges")
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    lows = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(lows)
