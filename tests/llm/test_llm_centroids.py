import hashlib
import math
import random

import numpy as np
import pytest
from brute_llm import k_means
from ebbline.llm import centroids

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="float"):
    """(vec_id, vector) rows with clashing columns."""
    full = [(i, v, "x", 1, "y") for i, v in rows]
    made = spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, id string, v int, cluster string")
    return made.repartition(3) if full else made


def usable(rows):
    whole = lambda x: math.floor(1024 * float(np.float32(x)))
    return [
        (i, [whole(x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]


def check(result, rows, **how):
    assigned, final = k_means(usable(rows), **how)
    total = sum(d for _, _, d in assigned)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
    expected = [
        (i, k, d, sum(e for _, other, e in assigned if other == k), total, digests[k]) for i, k, d in assigned
    ]
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(([r[n] for n in names] for r in result.collect()), key=repr) == sorted(map(list, expected), key=repr)


def drawn(seed, count, spread=0.1):
    random.seed(seed)
    middles = [[random.gauss(0, 0.3) for _ in range(64)] for _ in range(5)]
    return [(i, [m + random.gauss(0, spread) for m in random.choice(middles)]) for i in range(count)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = drawn(seed, 150)
    check(centroids.cluster_vectors(frame(spark, rows)), rows)


def test_odd_vectors(spark):
    rows = drawn(3, 30)
    hot = rows[0][1]
    rows += [(100, None), (101, []), (102, hot[:63]), (103, [*hot, 0.0]), (104, [None, *hot[1:]])]
    rows += [(105, [NAN, *hot[1:]]), (106, [INF, *hot[1:]]), (107, [-INF, *hot[1:]]), (108, [0.0] * 64)]
    rows += [(109, [-0.0] * 64), (110, [5.0, -7.25] * 32), (None, hot), (None, rows[3][1]), (-4, [-0.0004] * 64)]
    rows += [(7, hot)] * 40
    check(centroids.cluster_vectors(frame(spark, rows)), rows)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5] * 64), (1, [0.5] * 64), (2, [-0.5] * 64)]
    check(centroids.cluster_vectors(frame(spark, rows)), rows)
    check(centroids.cluster_vectors(frame(spark, [(9, [0.0] * 64)])), [(9, [0.0] * 64)])
    assert centroids.cluster_vectors(frame(spark, [])).collect() == []
    assert centroids.cluster_vectors(frame(spark, [(1, None), (2, [1.0])])).collect() == []


def test_empty_clusters_keep_their_centroid(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(40)]
    check(centroids.cluster_vectors(frame(spark, rows)), rows)


def test_large_components(spark):
    random.seed(8)
    rows = [(i, [random.uniform(-131071, 131071) for _ in range(64)]) for i in range(12)]
    whole = [(i, [float(math.floor(x)) for x in v]) for i, v in rows]
    check(centroids.cluster_vectors(frame(spark, whole, "double"), clusters=3), whole, clusters=3)
    with pytest.raises(Exception, match="component too large"):
        centroids.cluster_vectors(frame(spark, [(1, [131072.0] * 64)], "double")).collect()


def test_planes_give_exact_products():
    draw = np.random.default_rng(1)
    for bits in (2, 11, 28):
        values = draw.integers(-(1 << bits - 1), 1 << bits - 1, (50, 64))
        values[0], values[1] = -(1 << bits - 1), (1 << bits - 1) - 1
        planes = centroids.to_planes(values, bits)
        for other in range(5):
            exact = [sum(int(a) * int(b) for a, b in zip(row, values[other])) for row in values]
            assert centroids.dots(planes, planes[:, other]).tolist() == exact
        assert centroids.component_sums(planes).tolist() == values.sum(axis=0).tolist()
