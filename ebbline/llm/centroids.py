"""Centroid clustering of integer vectors by popcounts of bit planes.

Components are made whole numbers, floor(scale * x). Plane p of a vector is one 64-bit word that holds
bit p of all 64 components, in two's complement, so the top plane counts negatively. Then

    v . c = sum over planes p, q of weight(p) * weight(q) * popcount(v[p] & c[q])

is exact, and so are squared distances, |v|^2 - 2 v . c + |c|^2. Planes are written once; every round reads
them, assigns each vector inside its task and hands on one row per task and cluster: how many, and per
component the sum, again from counts of bits. What reaches the driver is the centroids, a number per
cluster and component. No vector moves, so a vector that a third of all rows share is no matter.

Vectors with another number of components, or with a null, NaN or infinite one, are left out; so are null
vectors. Repeated rows count each time. Seeds are ordered by the digest of their id, then by components;
null ids come last. With fewer vectors than clusters there are fewer clusters, and an empty table gives no
rows. Ties go to the smaller number; an empty cluster keeps its centroid. A whole number of 2^27 or more
raises, because squared distances would leave 64 bits. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbline.session import stage

COMPONENTS = 64
# Bits of a whole number without its sign.
MOST_BITS = 27
# Vectors that a task works on at a time.
AT_ONCE = 4096


@dataclass(frozen=True)
class Clustering:
    """(id, cluster, distance) per vector, and the centroids as whole numbers."""

    assigned: DataFrame
    centroids: tuple[tuple[int, ...], ...]


def whole_vectors(vectors: DataFrame, id_column: str, column: str, scale: int) -> DataFrame:
    """(id, v): ids as long and the usable vectors as arrays of whole numbers."""
    usable = (
        f"size({column}) = {COMPONENTS} AND NOT exists({column}, x -> x IS NULL OR isnan(x)"
        f" OR abs(CAST(x AS DOUBLE)) = CAST('Infinity' AS DOUBLE))"
    )
    limit = float(2**MOST_BITS)
    cell = f"floor({scale}D * CAST(x AS DOUBLE))"
    fits = f"{scale}D * CAST(x AS DOUBLE) >= -{limit!r}D AND {scale}D * CAST(x AS DOUBLE) < {limit!r}D"
    checked = f"IF({fits}, {cell}, CAST(raise_error(concat('component too large: ', x)) AS BIGINT))"
    return vectors.where(usable).selectExpr(
        f"CAST({id_column} AS BIGINT) AS id", f"transform({column}, x -> {checked}) AS v"
    )


def plane_weights(bits: int) -> list[int]:
    """What a set bit of each plane counts; the last plane is the sign."""
    return [1 << p for p in range(bits - 1)] + [-(1 << bits - 1)]


def to_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Planes by vectors, from whole numbers by vectors and components."""
    cells = (values[None, :, :] >> np.arange(bits)[:, None, None] & 1).astype(np.uint8)
    return np.packbits(cells, axis=2, bitorder="little").view("<u8")[:, :, 0]


def dots(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Products of every vector with one: ``planes`` by planes and vectors, ``other`` by planes (and vectors)."""
    weights = plane_weights(len(planes))
    total = np.zeros(planes.shape[1], np.int64)
    for p, plane in enumerate(planes):
        for q, word in enumerate(other):
            total += np.bitwise_count(plane & word).astype(np.int64) * (weights[p] * weights[q])
    return total


def component_sums(planes: np.ndarray) -> np.ndarray:
    """Sum of the vectors per component."""
    total = np.zeros(COMPONENTS, np.int64)
    for weight, plane in zip(plane_weights(len(planes)), planes, strict=True):
        cells = np.unpackbits(np.ascontiguousarray(plane).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += weight * cells.sum(axis=0, dtype=np.int64)
    return total


def _with_planes(vectors: DataFrame, bits: int) -> DataFrame:
    """(id, norm, planes) from (id, v); planes as the bytes of ``bits`` little-endian words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(start, AT_ONCE)
                values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
                planes = to_planes(values, bits)
                words = np.ascontiguousarray(planes.T).astype("<u8")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array(dots(planes, planes)),
                        pa.array([row.tobytes() for row in words], pa.binary()),
                    ],
                    ["id", "norm", "planes"],
                )

    return vectors.mapInArrow(run, "id long, norm long, planes binary")


def _blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded size with their planes, one plane after the other."""
    for whole in batches:
        for start in range(0, whole.num_rows, AT_ONCE):
            batch = whole.slice(start, AT_ONCE)
            words = np.frombuffer(b"".join(batch.column("planes").to_pylist()), "<u8").reshape(-1, bits)
            yield batch, np.ascontiguousarray(words.T)


def _nearest(norms: np.ndarray, planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid; the smaller number of equals."""
    of_centroids = to_planes(centroids, len(planes))
    distances = np.stack(
        [
            norms - 2 * dots(planes, of_centroids[:, k]) + int((centroids[k] * centroids[k]).sum())
            for k in range(len(centroids))
        ]
    )
    nearest = distances.argmin(axis=0)
    return nearest, distances[nearest, np.arange(len(norms))]


def _moved(planes: DataFrame, bits: int, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch, words in _blocks(batches, bits):
            nearest, _ = _nearest(batch.column("norm").to_numpy(), words, centroids)
            for k in np.unique(nearest):
                members = words[:, nearest == k]
                sums[k] += component_sums(members)
                sizes[k] += members.shape[1]
        held = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held, pa.int32()),
                pa.array(sizes[held]),
                pa.array(list(sums[held]), pa.list_(pa.int64())),
            ],
            ["cluster", "size", "sums"],
        )

    parts = planes.mapInArrow(run, "cluster int, size long, sums array<long>")
    cells = parts.select("cluster", "size", F.posexplode("sums").alias("component", "part"))
    totals = cells.groupBy("cluster", "component").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("size").alias("size")
    )
    after = centroids.copy()
    # One row per cluster and component.
    for row in totals.collect():
        after[row["cluster"], row["component"]] = int(row["total"]) // row["size"]
    return after


def _assigned(planes: DataFrame, bits: int, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _blocks(batches, bits):
            nearest, distance = _nearest(batch.column("norm").to_numpy(), words, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nearest, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"]
            )

    return planes.mapInArrow(run, "id long, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    seed: str = "3",
    scale: int = 1024,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> Clustering:
    """Assign every usable vector after ``rounds`` rounds; rounds that would change nothing are not run."""
    vectors = whole_vectors(vectors.select(id_column, column), id_column, column, scale)
    ends = vectors.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = (0 if end is None else end for end in ends)
    bits = 1 + max((-low - 1 if low < 0 else 0).bit_length(), max(high, 0).bit_length())
    planes = stage(_with_planes(vectors, bits), "planes")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    centroids = np.array([row["v"] for row in first], np.int64).reshape(-1, COMPONENTS)
    if len(centroids):
        for _ in range(rounds):
            after = _moved(planes, bits, centroids)
            if (after == centroids).all():
                break
            centroids = after
    return Clustering(_assigned(planes, bits, centroids), tuple(tuple(row) for row in centroids.tolist()))


def cluster_vectors(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: str = "3") -> DataFrame:
    """Per vector its cluster and distance, the inertia of the cluster and of all, and the centroid's digest."""
    found = cluster(vectors, clusters, rounds, seed)
    assigned = stage(found.assigned, "assigned")
    inertia = {row["cluster"]: row["inertia"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    rows = [(k, inertia.get(k, 0), sum(inertia.values()), digest) for k, digest in enumerate(digests)]
    named = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # A row per cluster: the size of the side broadcast here is fixed.
    return assigned.withColumnRenamed("id", "vec_id").join(F.broadcast(named), "cluster")
