import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from ebbline.llm import bpe

ALPHABET = "aeinrst  \n\t\x1c\x1d\x85  é漢字ßİ١½́'!?#$\x00　\U0001f600l've"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_queue_gives_lowest_rank_then_leftmost():
    random.seed(2)
    queue, held = bpe.RankQueue(70000), []
    for _ in range(5000):
        if held and random.random() < 0.45:
            held.sort()
            assert queue.pop() == held.pop(0)
        else:
            entry = (random.randrange(70000) if random.random() < 0.5 else 7, random.randrange(1000))
            queue.push(*entry)
            held.append(entry)
    assert len(queue.levels) == 3
    while held:
        held.sort()
        assert queue.pop() == held.pop(0)
    assert not queue.buckets and not any(any(level) for level in queue.levels)


def test_texts_encode_as_the_library_does(ranks, library):
    random.seed(3)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    texts = ["".join(random.choice(ALPHABET) for _ in range(random.randrange(200))) for _ in range(1500)]
    ascii_only = "".join(map(chr, range(128)))
    texts += ["".join(random.choice(ascii_only) for _ in range(random.randrange(200))) for _ in range(1500)]
    texts += ["a" * 3000, "ab" * 2000, "é" * 2000, " " * 900, "<|endoftext|>", "the" * 3000]
    for text in texts:
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(packed) == text.encode()


def test_long_texts_decode_in_parts(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "DECODED_AT_ONCE", 7)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert encoder.decode(encoder.encode(ALPHABET * 9)) == (ALPHABET * 9).encode()


def test_memory_of_pretokens_is_bounded(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    encoder.encode(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)))
    encoder.encode("y" * 1000)
    assert len(encoder.remembered) <= 10
    assert "y" * 1000 not in encoder.remembered


def test_queue_starts_with_pairs_below_their_neighbours(ranks, monkeypatch):
    random.seed(8)
    encoder, pushed, at_first = bpe.Encoder(ranks, public_tokenizers.PATTERN), [], []
    push, pop = encoder.queue.push, encoder.queue.pop
    monkeypatch.setattr(encoder.queue, "push", lambda rank, node: (pushed.append(node), push(rank, node)))
    monkeypatch.setattr(encoder.queue, "pop", lambda: (at_first.append(len(pushed)), pop())[1])
    piece = bytes(random.choices(b"etaoinsh", k=2000))
    encoder.merged(piece)
    pairs = sum(piece[i : i + 2] in ranks for i in range(len(piece) - 1))
    assert 0 < at_first[0] < pairs / 2


def test_merges_go_by_rank_in_any_vocabulary():
    """Also where a pair that a merge makes ranks below the merge itself."""
    random.seed(9)

    def by_hand(ranks, piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[part] for part in parts]
            _, at = min(pairs)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    for _ in range(40):
        letters = bytes(random.sample(range(256), 3))
        pieces = {bytes(random.choices(letters, k=random.randrange(2, 7))) for _ in range(50)}
        pieces = sorted(pieces | {bytes([letter]) for letter in letters})
        random.shuffle(pieces)
        ranks = {piece: rank for rank, piece in enumerate(pieces)}
        encoder = bpe.Encoder(ranks, ".")
        for _ in range(40):
            piece = bytes(random.choices(letters, k=random.randrange(1, 40)))
            # A whole piece of the vocabulary is itself, as in the library.
            assert encoder.merged(piece) == ([ranks[piece]] if piece in ranks else by_hand(ranks, piece))


def test_more_pretokens_are_remembered_where_asked(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400))
    wider, plain = bpe.Encoder(ranks, public_tokenizers.PATTERN, 500), bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert wider.encode(text) == plain.encode(text)
    assert len(plain.remembered) <= 10 < 400 == len(wider.remembered)


def test_odd_documents(documents, odd_rows, ranks, library):
    docs = documents(odd_rows)
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids="ids")
    # The column that was called so is replaced; all others pass as they are.
    assert sorted(encoded.columns) == sorted(docs.columns)
    rows = bpe.decode(encoded, ranks, "ids", "decoded").collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]).decode() == (row["text"] or "")


def test_digests(documents, odd_rows, ranks, library):
    rows = bpe.digests(documents(odd_rows), ranks, public_tokenizers.PATTERN, keep=["doc_id", "text"]).collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        ids = np.array(library.encode_ordinary(row["text"] or ""), "<u4")
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_empty_table(documents, ranks):
    assert bpe.digests(documents([]), ranks, public_tokenizers.PATTERN, keep=["doc_id"]).collect() == []


def test_query_on_the_whole_table(spark, sf_dir, ranks, library):
    from ebbline.llm import queries

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op2_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = np.array(library.encode_ordinary(texts[row["doc_id"]] or ""), "<u4")
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256((texts[row["doc_id"]] or "").encode()).hexdigest()
