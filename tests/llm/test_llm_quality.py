import random

import pytest
from brute_llm import host_rates, quality as measured
from ebbline.llm import quality
from ebbline.llm.quality import QualityOptions
from pyspark.sql import functions as F

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def sources(docs):
    return {(r["doc_id"], r["text"]): r["source"] for r in docs.collect()}


def expected(rows, docs, options=QualityOptions()):
    by_row = [(d, t, docs_source, measured(t)) for (d, t), docs_source in ((row, sources(docs)[row]) for row in rows)]
    rates = host_rates([(host, m[-1]) for _, _, host, m in by_row])
    return [(d, *m, not m[-1] and rates[host] <= options.max_host_rate) for d, _, host, m in by_row]


def sortable(rows):
    return sorted(tuple(-(2**63) if v is None else v for v in row) for row in rows)


def _one_source():
    return F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("src"), F.col("doc_id") % 2))


def test_odd_documents(documents, odd_rows):
    # Rows that repeat must have one source to be told apart here.
    docs = documents(odd_rows).withColumn("source", _one_source())
    found = quality.judge_documents(docs).collect()
    assert sortable((r["doc_id"], *[r[m] for m in MEASURES], r["kept"]) for r in found) == sortable(expected(odd_rows, docs))


def test_random_texts_with_repeated_runs(documents):
    random.seed(14)
    rows = []
    for i in range(300):
        pool = [f"w{k}" for k in range(random.choice([2, 5, 40]))]
        text = "".join(random.choice(pool) + random.choice([" ", "\n", "  ", "\t", " # "]) for _ in range(random.randrange(60)))
        rows.append((i, text))
    docs = documents(rows)
    found = quality.judge_documents(docs).collect()
    assert sortable((r["doc_id"], *[r[m] for m in MEASURES], r["kept"]) for r in found) == sortable(expected(rows, docs))


def test_prior_spares_small_hosts_and_rejects_large_bad_ones(spark):
    good, bad = "a fine text of more than ten words that says something new", "too short"
    rows = [(h * 1000 + i, good, f"good{h}") for h in range(8) for i in range(30)]
    rows += [(50_000 + i, bad if i < 180 else f"{good} number {i}", "bad") for i in range(200)]
    rows += [(60_000, bad, "tiny"), (60_001, f"{good} indeed", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r["kept"] for r in quality.judge_documents(docs).collect()}
    assert all(found[h * 1000 + i] for h in range(8) for i in range(30))
    # Of the bad host even its good texts go; one failure in two does not condemn the tiny one.
    assert not any(found[50_000 + i] for i in range(200))
    assert found[60_001] and not found[60_000]


def test_keep_good_keeps_rows_and_columns_as_they_are(documents, odd_rows):
    docs = documents(odd_rows).withColumn("source", _one_source())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    judged = {(r["doc_id"], r["n_words"], r["word_chars"]): r["kept"] for r in quality.judge_documents(docs).collect()}
    wanted = [r for r in docs.collect() if judged[(r["doc_id"], *measured(r["text"])[:2])]]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, wanted))


def test_empty_table(documents):
    assert quality.judge_documents(documents([])).collect() == []
    assert quality.keep_good(documents([])).collect() == []


@pytest.mark.parametrize("make", [quality.judge_documents, quality.keep_good])
def test_plan_is_native(documents, odd_rows, make):
    plan = make(documents(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
