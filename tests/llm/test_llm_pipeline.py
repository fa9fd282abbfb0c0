"""The pipeline's stages, each against brute force on what the stage before it really kept."""

import hashlib
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute_llm import contaminated, host_rates, kept_lines, near_groups, quality
from ebbline.llm import bpe
from ebbline.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The rows after each stage, the input first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results = [docs.collect()]
    for number, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number < 4:
            assert docs.columns == COLUMNS
        results.append(docs.collect())
    return results


def same(rows, expected):
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, expected), key=repr)


def test_quality_rules(stages):
    before, after = stages[0], stages[1]
    failed = {r["doc_id"]: quality(r["text"])[-1] for r in before}
    rates = host_rates([(r["source"], failed[r["doc_id"]]) for r in before])
    same(after, [r for r in before if not failed[r["doc_id"]] and rates[r["source"]] <= 0.5])
    assert 0 < len(after) < len(before)


def test_line_dedup(stages):
    before, after = stages[1], stages[2]
    left = kept_lines([(r["doc_id"], r["text"]) for r in before])
    same(after, [(r["doc_id"], text, r["lang"], r["source"], len(text)) for r, (text, _, _) in zip(before, left)])
    assert any(dropped for _, _, dropped in left)


def test_near_dedup(stages):
    before, after = stages[2], stages[3]
    groups = near_groups([(r["doc_id"], r["text"]) for r in before], 5)
    kept = {}
    for r, (n, root) in zip(before, groups):
        key = ("alone", r["doc_id"]) if not n else root
        kept[key] = min(kept.get(key, r), r, key=lambda row: row["doc_id"])
    same(after, kept.values())
    assert len(after) < len(before)


def test_benchmark_decontamination(spark, sf_dir, stages):
    before, after = stages[3], stages[4]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    same(after, [r for r in before if not contaminated(r["text"], items)])
    assert len(after) < len(before)


def test_byte_bpe(stages):
    before, after = {r["doc_id"]: r for r in stages[4]}, stages[5]
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(after) == len(before)
    for row in after:
        ids = np.array(library.encode_ordinary(before[row["doc_id"]]["text"]), "<u4")
        assert bytes(row["ids"]) == ids.tobytes() and row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(before[row["doc_id"]]["text"].encode()).hexdigest()


def test_run_gives_the_last_stage_and_leaves_nothing_else(spark, sf_dir, stages):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {path.name for path in folder.iterdir()}
    same(corpus_pipeline.run(spark, sf_dir).collect(), stages[5])
    [left] = [path for path in folder.iterdir() if path.name not in before]
    assert [path.name for path in left.iterdir()] == ["4"]


def test_stages_on_odd_and_empty_documents(spark, sf_dir, documents, odd_rows):
    for rows in (odd_rows, []):
        docs = documents(rows)
        columns = docs.columns
        for number, (_, function) in enumerate(corpus_pipeline.STAGES):
            docs = function(spark, docs, sf_dir)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            if number < 4:
                assert docs.columns == columns
        assert docs.count() <= len(rows)
