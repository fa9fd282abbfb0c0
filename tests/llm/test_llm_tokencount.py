import random

import public_tokenizers
import pytest
from ebbline.llm import queries, tokencount
from tokenizers import Tokenizer, models, pre_tokenizers


def library(pieces, with_bytes):
    made = Tokenizer(models.Unigram(pieces, 0, byte_fallback=with_bytes))
    made.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return made


@pytest.fixture(scope="module")
def pieces():
    return tokencount.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


# Few different scores, so that most choices are ties.
TIED = [("<unk>", 0.0)] + [(p, -float(len(p) % 3)) for p in ("▁", "a", "ab", "ba", "▁a", "aba", "b", "bb", "▁ab", "e")]


@pytest.mark.parametrize("kind", ["full", "without bytes", "tied"])
def test_counts_equal_the_library(pieces, kind):
    random.seed(4)
    own = {"full": pieces, "without bytes": [p for p in pieces if not p[0].startswith("<0x")], "tied": TIED}[kind]
    counter = tokencount.Counter(own)
    assert counter.bytes == (kind == "full")
    reference = library(own, counter.bytes)
    texts = ["".join(random.choice("ab e▁é\n漢") for _ in range(random.randrange(50))) for _ in range(3000)]
    texts += ["", " ", "  ", "▁", "<s> <0x41> </s>", "a" * 4000, "The quick brown fox " * 50]
    for text in texts:
        assert counter.text(text)[0] == len(reference.encode(text, add_special_tokens=False).ids), text


def test_score_is_that_of_the_best_segmentation():
    counter = tokencount.Counter([("▁", -5.0), ("a", -1.0), ("aa", -1.5), ("▁a", -4.0)])
    # ▁a aa: -5.5 in two pieces; ▁ aa a: -7.5; ▁a a a: -6.
    assert counter.text("aaa") == (2, -5.5)


def test_memory_of_words_is_bounded(pieces, monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED", 10)
    counter = tokencount.Counter(pieces)
    counter.text(" ".join(f"word{i}" for i in range(100)) + " " + "z" * 500)
    assert len(counter) <= 10 and "z" * 500 not in counter


def test_odd_documents(documents, odd_rows, pieces):
    reference = library(pieces, True)
    rows = tokencount.count_tokens(documents(odd_rows), pieces).collect()
    expected = [(doc_id or 0, len(reference.encode(text or "", add_special_tokens=False).ids)) for doc_id, text in odd_rows]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == sorted(expected)


def test_empty_tables(documents, odd_rows, pieces):
    assert tokencount.count_tokens(documents([]), pieces).collect() == []
    # Without any piece every character is unknown, and runs of them count as one.
    rows = tokencount.count_tokens(documents([(1, "ab cd"), (2, None)]), []).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in rows) == [(1, 2), (2, 0)]


def test_query_on_the_whole_table(spark, sf_dir, pieces):
    reference = library(pieces, True)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r["doc_id"]: r["n_tokens"] for r in queries.op10_token_counts(spark, sf_dir).collect()}
    assert found == {d["doc_id"]: len(reference.encode(d["text"] or "", add_special_tokens=False).ids) for d in docs}
