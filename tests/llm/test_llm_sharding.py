import random

import pytest
from brute_llm import jump
from ebbline.llm import sharding

LIMIT = 2**63


def test_jumps_equal_the_published_loop(spark):
    random.seed(1)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), None, *(random.randrange(-LIMIT, LIMIT) for _ in range(500))]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 40, 1000):
        found = sharding.with_shards(frame, "k", shards).collect()
        assert sorted((r["k"] or 0, r["shard"], r["grown_shard"]) for r in found) == sorted(
            (k or 0, jump(k, shards), jump(k, shards + 1)) for k in keys
        )


def test_growing_moves_rows_only_into_the_new_shard(spark):
    rows = sharding.with_shards(spark.range(20000), "id", 40).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {40}
    assert 20000 / 41 * 0.8 < len(moved) < 20000 / 41 * 1.2


def test_slots_are_gapless_and_ordered_with_a_hot_shard_and_copies(spark):
    frame = spark.createDataFrame([(0 if i % 3 else i % 4, i // 5) for i in range(3000)], "g int, k long")
    rows = sharding.with_slots(frame, "g", ["k"], rows_per_part=100).collect()
    for group in range(4):
        mine = sorted((r["slot"], r["k"]) for r in rows if r["g"] == group)
        assert [slot for slot, _ in mine] == list(range(len(mine)))
        assert [k for _, k in mine] == sorted(k for _, k in mine)


def test_odd_documents(documents, odd_rows):
    import zlib

    rows = sharding.shard_documents(documents(odd_rows)).collect()
    found = sorted((r["doc_id"] or 0, r["size"], r["text_crc32"], r["shard"], r["grown_shard"], r["law"]) for r in rows)
    expected = []
    for doc_id, text in odd_rows:
        data = (text or "").encode()
        expected.append((doc_id or 0, len(data) + 16, zlib.crc32(data), jump(doc_id, 40), jump(doc_id, 41), "key"))
    assert found == sorted(expected)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_empty_table(documents):
    assert sharding.shard_documents(documents([])).collect() == []


@pytest.mark.parametrize("word", ["Python", "Arrow", "Pandas"])
def test_plan_is_native(documents, odd_rows, word):
    plan = sharding.shard_documents(documents(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert word not in plan
