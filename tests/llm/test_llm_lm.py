import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute_llm import base_scores, model_scores
from ebbline.llm import gru, lm, queries
from ebbline.llm.gru import GruOptions
from ebbline.llm.lm import LmOptions


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def model(symbols=10, hidden=4, members=3):
    options, rng = GruOptions(hidden=hidden, members=members, window=5, lanes=3), np.random.default_rng(16)
    weights = gru.initial(rng.integers(1, 9, symbols).astype(float), options)
    return {n: v.astype(np.float64) + rng.normal(0, 0.3, v.shape) for n, v in weights.items()}, options, rng


def test_gradients_equal_differences():
    weights, options, rng = model()
    inputs, targets = rng.integers(0, 10, (2, 5, 3))
    keep, used, state = (rng.random((5, 3)) > 0.3) * 1.0, (rng.random((5, 3)) > 0.2) * 1.0, rng.normal(0, 1, (3, 4))
    grads = gru.gradients(weights, inputs, targets, keep, used, state)[1]
    for name, value in weights.items():
        flat = value.reshape(-1)
        for place in rng.choice(flat.size, min(8, flat.size), replace=False):
            was, losses = flat[place], []
            for step in (1e-3, -1e-3):
                flat[place] = was + step
                losses.append(gru.gradients(weights, inputs, targets, keep, used, state)[0])
            flat[place] = was
            slope = (losses[0] - losses[1]) / 2e-3
            assert abs(slope - grads[name].reshape(-1)[place]) < 1e-2 * max(1, abs(slope))


def test_state_is_carried_through_the_whole_document():
    weights, _, rng = model()
    documents = [rng.integers(0, 10, n) for n in (1, 2, 300, 17, 16, 40)]
    whole = gru.score(weights, documents, 0, GruOptions(hidden=4, members=3, scored_window=1000, lanes=1))
    for window, lanes in ((1, 2), (7, 6), (16, 100)):
        cut = gru.score(weights, documents, 0, GruOptions(hidden=4, members=3, scored_window=window, lanes=lanes))
        assert np.allclose(whole, cut, rtol=1e-5)
    # Step by step, from the definition.
    h, before, total = np.zeros(4), 0, 0.0
    for symbol in documents[2]:
        given, own = weights["input"][before], h @ weights["recurrent"]
        z, r = 1 / (1 + np.exp(-(given[:4] + own[:4]))), 1 / (1 + np.exp(-(given[4:8] + own[4:8])))
        h = (1 - z) * np.tanh(given[8:] + r * own[8:]) + z * h
        group = np.exp(h @ weights["class"] + weights["class_bias"])
        member = np.exp(h @ weights["member"][symbol // 3] + weights["member_bias"][symbol // 3])
        total += np.log(group[symbol // 3] / group.sum() * member[symbol % 3] / member.sum())
        before = symbol
    assert whole[2] == pytest.approx(total, rel=1e-5)


def test_lanes_of_scoring_change_no_score():
    weights, _, rng = model()
    documents = [rng.integers(0, 10, n) for n in (1, 2, 300, 17, 16, 40)]
    one, two, many = (
        gru.score(weights, documents, 0, GruOptions(hidden=4, members=3, scored_window=7, scored_lanes=lanes))
        for lanes in (1, 2, 100)
    )
    assert np.allclose(one, two, rtol=1e-5) and np.allclose(one, many, rtol=1e-5)


def test_large_slices_are_trained_in_512_lanes(monkeypatch):
    shapes = []
    monkeypatch.setattr(gru, "gradients", lambda w, x, y, k, u, state: (shapes.append(x.shape), (0.0, {}, state))[1])
    gru.Trainer({}, 0, GruOptions()).learn([np.zeros(1_200_000, np.int64)])
    # Every window is an update, so more lanes would be fewer of them.
    assert {lanes for _, lanes in shapes} == {512}
    assert len(shapes) == -(-1_200_000 // (512 * 16))


def test_probabilities_of_all_symbols_sum_to_one():
    weights, _, rng = model(symbols=12)
    states = rng.normal(0, 1, (1, 4))
    shares = [gru.log_likelihoods(weights, states, np.array([s]))[0] for s in range(12)]
    assert np.exp(shares).sum() == pytest.approx(1)


def test_training_learns_an_alternation():
    options = GruOptions(hidden=8, members=2, lanes=16)
    documents = [np.array([1, 2] * 40 + [0]) for _ in range(400)]
    start = gru.initial(np.array([400.0, 16000, 16000]), options)
    trainer = gru.Trainer(start, 0, options)
    trainer.learn(documents)
    before, after = (gru.score(w, documents[:5], 0, options).sum() for w in (start, trainer.weights))
    assert after > before / 4


def scored(frame):
    return sorted(
        ((r["doc_id"] or 0), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in frame.collect()
    )


def compared(found, rows):
    each, total = base_scores(rows, is_held_out)
    expected = sorted((d or 0, is_held_out(d), *e[:2], total, e[2]) for (d, _), e in zip(rows, each))
    assert [f[:5] for f in found] == [e[:5] for e in expected]
    assert [f[5] for f in found] == pytest.approx([e[5] for e in expected], rel=1e-9)


def test_odd_documents(documents, odd_rows):
    compared(scored(lm.score_documents(documents(odd_rows))), odd_rows)


@pytest.mark.parametrize("local_words", [0, 40, 10_000])
def test_how_many_words_are_broadcast_does_not_matter(documents, local_words):
    rng = np.random.default_rng(17)
    rows = [(i, " ".join(f"W{int(k)}" for k in rng.zipf(1.3, 60) % 900)) for i in range(150)]
    options = LmOptions(vocabulary=20, local_words=local_words, gru=GruOptions(hidden=4, members=4))
    compared(scored(lm.score_documents(documents(rows), options)), rows)


@pytest.mark.parametrize("local_words", [0, 40, 10_000])
def test_scores_equal_brute_force_for_given_weights(documents, monkeypatch, local_words):
    """Symbols, the symbol of all other words, and words that are not broadcast."""
    rng = np.random.default_rng(18)
    rows = [(i, " ".join(f"W{int(k)}" for k in rng.zipf(1.3, int(rng.integers(0, 90))) % 900)) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "x" * 5000 + " w1 unseen"), (None, "w1 w2")]
    options = LmOptions(vocabulary=20, local_words=local_words, gru=GruOptions(hidden=4, members=4))
    weights = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in gru.initial(np.ones(22), options.gru).items()}
    monkeypatch.setattr(lm, "train", lambda *args: weights)
    found = {r["doc_id"]: r["score"] for r in lm.score_documents(documents(rows), options).collect()}
    expected = model_scores(rows, weights, is_held_out, 20)
    assert [found[d] for d, _ in rows] == pytest.approx(expected, rel=1e-4)


def test_scores_do_not_depend_on_the_partitions(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    options = LmOptions(vocabulary=200, learner_tokens=20_000, gru=GruOptions(hidden=8))
    found = []
    for parts in (1, 8, 64):
        scores = lm.score_documents(rows.repartition(parts, "text"), options).collect()
        found.append([r["score"] for r in sorted(scores, key=lambda r: r["doc_id"])])
    assert found[1] == pytest.approx(found[0], rel=1e-5) and found[2] == pytest.approx(found[0], rel=1e-5)


def test_symbols_do_not_hang_on_what_is_broadcast(spark):
    rows = [("often", 1000), ("b", 7), ("a", 7), ("c", 3), ("y" * 300, 50)]
    counts = spark.createDataFrame(rows, "token string, c long")
    for local_words in (0, 2, 100):
        found = lm.most_frequent(counts, 10, LmOptions(vocabulary=2, local_words=local_words))
        assert found.words[:2] == [(b"often", 1000), (b"a", 7)] and found.symbols == 2
        assert len(found.words) == (4 if local_words == 100 else 2) and found.distinct == 5


def test_score_is_a_probability_over_all_words(documents):
    # One-word texts over all known words, an unknown one and the bare end: shares add up to about one.
    words = [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(words[: 1 + i % 30])) for i in range(200)]
    learned = [row for row in rows if not is_held_out(row[0])]
    held = [d for d in range(1000, 4000) if is_held_out(d)][:31]
    asked = learned + list(zip(held, [*words, "unseen"]))
    options = LmOptions(vocabulary=10, local_words=20, gru=GruOptions(hidden=4, members=4))
    found = {r["doc_id"]: r for r in lm.score_documents(documents(asked), options).collect()}
    # P(word, end) is at most P(word), and the words' shares add up to less than one.
    total = sum(10 ** found[d]["score"] for d in held)
    assert 0 < total <= 1 and all(found[d]["held_out"] for d in held)


def test_nothing_to_learn_from(documents):
    held = next(d for d in range(100) if is_held_out(d))
    rows = lm.score_documents(documents([(held, "a b"), (held, None)])).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows) == [(1, 0, 0), (3, 0, 0)]
    assert all(r["base_score"] == 0 for r in rows)


def test_empty_table(documents):
    assert lm.score_documents(documents([])).collect() == []


def test_averaging_is_by_tokens_and_in_groups(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP", 3)
    like = {"a": np.zeros(2, np.float32)}
    rows = [(p, p + 1, gru.pack({"a": np.array([p, 1], np.float32)})) for p in range(20)]
    mean = lm._averaged(spark.createDataFrame(rows, lm.WEIGHTS_DDL), like)
    assert mean["a"] == pytest.approx([sum(p * (p + 1) for p in range(20)) / 210, 1], rel=1e-5)


def test_query_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    frame = queries.op4_lm_scoring(spark, sf_dir).cache()
    compared(scored(frame), rows)
    # Held-out documents are likelier under the model than under the counts alone.
    held = frame.where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]
    frame.unpersist()


def test_words_are_split_for_a_whole_slice_at_once():
    """As bytes.lower and bytes.split do, text by text."""
    texts = ["", " ", "A b", "\tB\x0b\x0cÉ\r\n", "x\x1cy\x85z\xa0w\u3000v\x00", "  Ünd   ÀB ", "a" * 3000]
    words, sizes = lm.split_words(pa.array(texts, pa.string()))
    wanted = [text.encode().lower().split() for text in texts]
    assert words.cast(pa.binary()).to_pylist() == [word for of_text in wanted for word in of_text]
    assert sizes.tolist() == [len(of_text) for of_text in wanted]
    coder = lm._Coder(lm.Vocabulary([(b"b", 3), (b"a", 2), (b"w", 1)], 2, 1, 6, 3))
    assert coder.numbers(pa.array(["w", "a", "q"])).tolist() == [2, 1, 3]
    coded = coder.code(pa.array(["", "a w b", "q"]))
    assert [c.tolist() for c in coded] == [[lm.END], [3, lm.OTHER, 2, lm.END], [lm.OTHER, lm.END]]
    assert {c.dtype for c in coded} == {np.dtype(np.int32)}
