import random

import pytest
from brute_llm import contaminated, tiling
from ebbline.llm import decontam, queries


def benchmark(spark, items):
    return spark.createDataFrame([(*item, "clash") for item in items], "item_id long, text string, hits string")


ITEMS = [
    (0, "one two three four five six seven eight nine ten"),
    (1, "Alpha, beta; gamma! delta epsilon zeta. Eta theta iota kappa lambda mu."),
    (2, None),
    (3, ""),
    (None, "an item without an id is an item all the same"),
    (4, "tiny item"),
    (5, "tiny item"),
    (6, "repeat repeat repeat repeat repeat repeat repeat repeat"),
    (7, "été漢字 straße naïve façade Ünïcödé words here"),
]


def judged(frame):
    return sorted(
        ((r["doc_id"] or 0), sorted(i or 0 for i in r["item_ids"]), r["contaminated"]) for r in frame.collect()
    )


def expected(rows, items):
    held = [(doc_id or 0, sorted(i or 0 for i in contaminated(text, items))) for doc_id, text in rows]
    return sorted((doc_id, ids, bool(ids)) for doc_id, ids in held)


def test_tiling_equals_brute_force():
    random.seed(15)
    for _ in range(2500):
        text = [random.randrange(1, 4) for _ in range(random.randrange(25))]
        item = [random.randrange(1, 4) for _ in range(random.randrange(1, 15))]
        least = random.randrange(1, 5)
        assert decontam.tiled(text, item, least) == tiling(text, item, least)


def test_reordered_and_edited_passages_are_caught(documents, spark):
    first, second = "alpha beta gamma delta epsilon zeta", "eta theta iota kappa lambda mu"
    rows = [
        (1, f"before {first} {second} after"),
        (2, f"{second} in between {first}"),
        (3, f"{first.upper()}!! something else altogether"),
        (4, "alpha beta gamma delta other zeta eta theta iota other lambda mu"),
        (5, "alpha beta gamma delta epsilon"),
        (6, "nothing of the kind at all in here"),
    ]
    found = {r["doc_id"]: r for r in decontam.judge_documents(documents(rows), benchmark(spark, ITEMS)).collect()}
    assert [found[d]["contaminated"] for d in range(1, 7)] == [True, True, True, False, False, False]
    assert found[2]["item_ids"] == [1] and found[2]["coverage"] == 1.0
    assert found[5]["coverage"] == pytest.approx(5 / 12)


@pytest.mark.parametrize("block_bytes", [16_000_000, 60])
def test_odd_documents_and_blocks(documents, odd_rows, spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block_bytes)
    rows = [r for r in odd_rows if len(r[1] or "") < 10000] + [
        (20, "TINY item"), (21, "an item without an ID is an item all the same"), (22, "repeat " * 30),
        (23, "été漢字 straße naïve façade ünïcödé words here"),
    ]
    docs = documents(rows)
    assert judged(decontam.judge_documents(docs, benchmark(spark, ITEMS))) == expected(rows, ITEMS)


def test_blocks_are_bounded_whatever_the_items_are(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 2_000)
    items = [(7, "the very same item again and again")] * 1000 + [(8, "long " * 900)] + [(i, f"item {i}") for i in range(200)]
    blocks = [decontam._items(block) for block in decontam._blocks(benchmark(spark, items))]
    assert sorted(row for block in blocks for row in block) == sorted(items)
    sizes = [sum(len(text) + 32 for _, text in block) for block in blocks]
    assert max(size for size, block in zip(sizes, blocks) if (8, "long " * 900) not in block) <= 2_000
    assert len(blocks) <= 2 * sum(sizes) / 2_000


def test_twenty_blocks_write_no_text(documents, odd_rows, spark, monkeypatch):
    staged, stage = [], decontam.stage

    def noted(df, label):
        staged.append((label, df.columns))
        return stage(df, label)

    monkeypatch.setattr(decontam, "stage", noted)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 60)
    docs = documents([r for r in odd_rows if len(r[1] or "") < 10000])
    decontam.keep_clean(docs, benchmark(spark, ITEMS * 3)).collect()
    assert len([1 for label, _ in staged if label == "decontam-hits"]) >= 20
    assert all("text" not in columns for label, columns in staged if label != "decontam-items")


def test_a_run_of_one_token_is_compared_by_its_ends():
    """A pair of places inside two runs is part of a match that starts earlier, and is not visited."""
    text, item = [1] * 6000, [1] * 400
    found = decontam._matches(text, item, [False] * 6000, [False] * 400, 5)
    assert len(found) <= 6400 and found[0] == (-400, 0, 0)
    assert decontam.tiled(text, item, 5) == 400
    assert decontam.tiled(([1] * 6 + [2]) * 200, item, 5) == 396


def test_keep_clean_keeps_columns_and_long_texts(documents, odd_rows, spark):
    rows = [*odd_rows, (30, " ".join(f"w{i}" for i in range(30000)) + " " + ITEMS[1][1])]
    docs = documents(rows)
    kept = decontam.keep_clean(docs, benchmark(spark, ITEMS))
    assert kept.columns == docs.columns
    holding = [r for r in rows if "one two three" in (r[1] or "") or r[0] == 30]
    assert kept.count() == len(rows) - len(holding)
    assert kept.where("doc_id = 30").isEmpty()


def test_empty_tables(documents, odd_rows, spark):
    assert decontam.judge_documents(documents([]), benchmark(spark, ITEMS)).collect() == []
    rows = decontam.judge_documents(documents(odd_rows), benchmark(spark, [])).collect()
    assert len(rows) == len(odd_rows) and not any(r["contaminated"] for r in rows)


def test_query_on_the_whole_table(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = judged(queries.op7_decontamination(spark, sf_dir))
    assert found == expected(rows, items)
    assert any(flag for _, _, flag in found) and not all(flag for _, _, flag in found)
