import random

import numpy as np
import pytest
from brute_llm import kept_lines
from ebbline.llm import linededup
from ebbline.llm.linededup import CuckooFilter, LineIndex, LineOptions


def rewritten(index, docs):
    rows = index.rewrite(docs).collect()
    return sorted((r["row"]["doc_id"] or 0, r["kept"], r["n_lines"], r["n_dropped"]) for r in rows)


def expected(rows, of=None):
    """What is left of ``rows`` when the documents ``of`` (the same ones) are in the index."""
    found = dict(zip(map(str, of or rows), kept_lines(of or rows)))
    return sorted((doc_id or 0, *found[str((doc_id, text))]) for doc_id, text in rows)


def test_filter_holds_what_was_inserted_and_forgets_what_was_deleted():
    rng = np.random.default_rng(5)
    keys = rng.integers(-(2**63), 2**63 - 1, 6000)
    held = CuckooFilter.empty(3000)
    held.insert(keys[:5000])
    assert held.probe(keys[:5000]).all()
    held = CuckooFilter.load(held.dump())
    held.delete(keys[:2500])
    assert held.probe(keys[2500:5000]).all()
    assert held.probe(keys[:2500]).mean() < 0.01
    assert len(held) == 2500


def test_equal_fingerprints_overflow_into_the_stash():
    held = CuckooFilter.empty(4)
    held.insert(np.full(30, 12345))
    assert held.stash and held.probe(np.array([12345])).all()
    held.delete(np.full(29, 12345))
    assert held.probe(np.array([12345])).all()
    held.delete(np.array([12345]))
    assert not held.probe(np.array([12345])).any() and not len(held)


def test_odd_documents(documents, odd_rows):
    docs = documents(odd_rows)
    rows = linededup.dedup_lines(docs)
    assert rewritten(LineIndex.empty(docs.sparkSession).insert(docs), docs) == expected(odd_rows)
    assert rows.schema["row"].dataType.names == docs.columns


def test_end_values_and_nulls_are_ids_of_their_own(documents):
    top, low = 2**63 - 1, -(2**63)
    line = "a line that three documents have, whatever their ids"
    rows = [(low, line), (None, line + "\nand more"), (7, line), (top, "a line of its own, long enough"), (None, line)]
    index = LineIndex.empty(documents(rows).sparkSession).insert(documents(rows))
    assert sorted((r["id"] is not None, r["id"]) for r in index.dropped().collect()) == [(False, None), (True, low)]
    found = {(r["row"]["doc_id"], r["row"]["text"]): r["kept"] for r in index.rewrite(documents(rows)).collect()}
    assert found == {
        (low, line): "", (None, line + "\nand more"): "and more", (7, line): line, (None, line): "",
        (top, "a line of its own, long enough"): "a line of its own, long enough",
    }
    index = index.delete(documents([(None, "")]))
    assert index.dropped().collect() == [] and index.refs.where("n > 2").isEmpty()


def test_many_rows_without_an_id_or_with_one_id(documents):
    """Each loses what it holds itself, and no list of lost keys is longer than a text."""
    random.seed(31)
    pool = [f"line number {i} that is long enough to be counted" for i in range(60)]
    rows = [(None if i % 3 else i % 2, "\n".join(random.sample(pool, 4))) for i in range(150)]
    rows += [(1000 + i, "\n".join(random.sample(pool, 4))) for i in range(60)] + rows[:20]
    docs = documents(rows)
    index = LineIndex.empty(docs.sparkSession, LineOptions(shards=3)).insert(docs)
    assert rewritten(index, docs) == expected(rows)
    many = docs.groupBy("doc_id").count().where("count > 1").selectExpr("doc_id AS id")
    assert max(len(r["lost"]) for r in index._lost(docs, many).collect()) <= 4


def test_empty_table(documents):
    assert linededup.dedup_lines(documents([])).collect() == []


def corpus(seed, documents_, lines):
    random.seed(seed)
    pool = [f"  Line number {i} that is Long enough to count " for i in range(lines)]
    # One line is in a third of all documents and more.
    return [
        (i, "\n".join([*random.sample(pool, 3), *(["the line that everybody has got"] if i % 3 else []), f"short {i}"]))
        for i in range(documents_)
    ]


def test_inserting_and_deleting_equals_starting_anew(spark, documents):
    rows, options = corpus(6, 120, 40), LineOptions(shards=4)
    index = LineIndex.empty(spark, options)
    for part in (rows[:50], rows[50:], rows[:10]):
        index = index.insert(documents(part))
    assert rewritten(index, documents(rows)) == expected(rows)
    gone = [doc_id for doc_id, _ in rows if doc_id >= 60 or doc_id % 7 == 0]
    index = index.delete(spark.createDataFrame([(d,) for d in gone], "doc_id long"))
    rest = [row for row in rows if row[0] not in set(gone)]
    assert rewritten(index, documents(rest)) == expected(rest)
    # Documents that are gone, or never came, lose nothing; and they can come back.
    lost = index.rewrite(documents([rows[100]])).collect()[0]
    assert lost["n_dropped"] == 0
    index = index.insert(documents([row for row in rows if row[0] in set(gone)]))
    assert rewritten(index, documents(rows)) == expected(rows)


def test_everything_deleted_leaves_an_empty_index(spark, documents):
    rows = corpus(7, 30, 5)
    index = LineIndex.empty(spark, LineOptions(shards=2)).insert(documents(rows))
    index = index.delete(documents(rows))
    assert index.refs.count() == 0 and index.postings.count() == 0
    for row in index.filters.collect():
        assert len(CuckooFilter.load(bytes(row["filter"]))) == 0


@pytest.mark.parametrize("shards", [1, 64])
def test_number_of_shards_does_not_matter(documents, shards):
    rows = corpus(8, 90, 30)
    docs = documents(rows)
    index = LineIndex.empty(docs.sparkSession, LineOptions(shards=shards)).insert(docs)
    assert rewritten(index, docs) == expected(rows)


def test_filters_hold_back_most_keys(documents):
    rows = [(i, f"a line that only document {i} has got, {i}") for i in range(400)]
    rows += [(400 + i, "one line that quite a few documents have") for i in range(5)]
    docs = documents(rows)
    index = LineIndex.empty(docs.sparkSession, LineOptions(shards=2)).insert(docs)
    held = [CuckooFilter.load(bytes(r["filter"])) for r in index.filters.collect()]
    assert sum(map(len, held)) == 1
    assert sorted(r["id"] for r in index.dropped().collect()) == [400, 401, 402, 403]
