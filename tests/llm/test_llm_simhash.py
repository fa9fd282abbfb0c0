import random

import numpy as np
import pyarrow as pa
import pytest
from brute_llm import near_numbers, simhash
from ebbline.llm import queries, simhash as operator
from ebbline.llm.components import components


def labels(rows):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows, by brute force."""
    marks = [simhash(text) for _, text in rows]
    roots = near_numbers(marks, 3)
    lowest = {}
    for (doc_id, _), root in zip(rows, roots):
        ids = lowest.setdefault(root, [])
        ids += [] if doc_id is None else [doc_id]
    return sorted(
        ((i, f"{mark:016x}", min(lowest[root], default=None)) for (i, _), mark, root in zip(rows, marks, roots)), key=repr
    )


def found_labels(frame):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in frame.collect()), key=repr)


def flipped(number, bits):
    for bit in random.sample(range(64), bits):
        number ^= 1 << bit
    return number


def joined(spark, numbers, **how):
    """Components over the operator's edges, as the first row of each."""
    signed = np.array(numbers, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(n,) for n in set(signed)], "fp long").repartition(4)
    found = {r["node"]: r["component"] for r in components(operator.find_links(frame, **how)).collect()}
    first = {}
    return [first.setdefault(found.get(n, n), row) for row, n in enumerate(signed)]


def test_odd_documents(documents, odd_rows):
    assert found_labels(operator.label_documents(documents(odd_rows))) == labels(odd_rows)


def test_texts_without_words_are_linked_with_each_other(documents):
    rows = [(4, None), (2, ""), (3, " \t\n"), (None, None), (9, "some words of a text")]
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in operator.label_documents(documents(rows)).collect()}
    assert {found[i] for i in (2, 3, 4, None)} == {("0" * 16, 2)}
    assert found[9][1] == 9


def test_only_null_ids(documents):
    rows = operator.label_documents(documents([(None, "a b c d"), (None, "a b c d")])).collect()
    assert [r["component_id"] for r in rows] == [None, None]


def test_empty_table(documents):
    assert operator.label_documents(documents([])).collect() == []


def test_whole_table_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found_labels(queries.op12_simhash(spark, sf_dir)) == labels([tuple(r) for r in rows])


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_links_at_exactly_the_radius(spark, radius):
    random.seed(radius)
    numbers = []
    for _ in range(150):
        number = random.getrandbits(64)
        numbers += [number, flipped(number, radius), flipped(number, radius + 1)]
    assert joined(spark, numbers, radius=radius) == near_numbers(numbers, radius)


@pytest.mark.parametrize("block", [40, 100, 16384])
def test_dense_families_in_blocks(spark, block):
    random.seed(block)
    numbers = [0, 2**64 - 1]
    for spread in (2, 4, 6, 9):
        center = random.getrandbits(64)
        numbers += [flipped(center, random.randrange(spread + 1)) for _ in range(200)]
    # A chain whose ends are far apart.
    chain = [random.getrandbits(64)]
    for step in range(20):
        chain.append(chain[-1] ^ (7 << 3 * step))
    numbers = [*dict.fromkeys(numbers + chain)]
    assert joined(spark, numbers, block=block) == near_numbers(numbers, 3)


@pytest.mark.parametrize("small,queries,rows", [(2, 1, 10), (16, 4, 300), (64, 32, 65536)])
def test_groups_across_batches(monkeypatch, small, queries, rows):
    monkeypatch.setattr(operator, "SMALL", small)
    monkeypatch.setattr(operator, "QUERIES", queries)
    monkeypatch.setattr(operator, "ROWS_AT_ONCE", rows)
    random.seed(small)
    keys, numbers = [], []
    for key in range(40):
        center, count = random.getrandbits(64), random.choice([1, 2, 3, 5, 20, 70, 150])
        keys += [key] * count
        numbers += [flipped(center, random.randrange(6)) for _ in range(count)]
    columns = {"key": keys, "i": [0] * len(keys), "j": [0] * len(keys), "own": [0] * len(keys)}
    table = pa.table(columns | {"fp": pa.array(np.array(numbers, np.uint64).view(np.int64))})
    edges = [edge for part in operator._edges(3)(iter(table.to_batches(97))) for edge in zip(*[c.to_pylist() for c in part.columns])]
    linked = {n: n for n in numbers}

    def root(n):
        while linked[n] != n:
            n = linked[n]
        return n

    for u, v in edges:
        linked[root(u % 2**64)] = root(v % 2**64)
    for key in range(40):
        own = [n for k, n in zip(keys, numbers) if k == key]
        first = {}
        assert [first.setdefault(root(n), row) for row, n in enumerate(own)] == near_numbers(own, 3)


def test_a_hot_family_stays_linear_in_rows(spark):
    random.seed(5)
    center = random.getrandbits(64)
    numbers = {flipped(center, random.randrange(1, 4)) for _ in range(4000)}
    signed = np.array(list(numbers), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(n,) for n in signed], "fp long")
    # One edge at most per fingerprint and key: never the millions of links.
    assert operator.find_links(frame).count() <= 10 * len(numbers)


def test_counter_runs_over_above_the_radius():
    for radius in range(1, 9):
        counter = operator.Counter((1,), radius)
        for count in range(1, 12):
            counter.add(np.array([operator.ALL]))
            assert (counter.over[0] == operator.ALL) == (count > radius)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{i % 311}" for i in range(3000))
    whole = operator.fingerprint(operator.shingle_hashes(text.encode(), 3))
    monkeypatch.setattr(operator, "HASHES_AT_ONCE", 7)
    assert operator.fingerprint(operator.shingle_hashes(text.encode(), 3)) == whole == simhash(text)
