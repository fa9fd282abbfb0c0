"""Language-model scoring of documents: token counts over the whole corpus and a recurrent model.

Tokens are runs of other characters than white space, A-Z folded, and one end per document. All
documents whose ``crc32(doc_id as text) mod 7`` is not 2 are learned from; all documents are scored.

* Counts: every task adds up its own documents, the sums are combined by token. Base score: add-one
  unigrams over the full counts.
* Model: a gated recurrent network (``gru``) whose symbols are the most frequent words, the end, and
  one symbol for all other words, which then have their add-one share among such words. So every
  token of a text has its probability under the model. Documents are dealt to learners by a hash of id and
  text, a learner for about every ``learner_tokens`` tokens, whatever the partitions of the input are. A learner
  trains on its documents in the order of the hash, from the same start as the others, by truncated
  backpropagation; the weights are averaged by tokens, in groups of bounded size. ``rounds`` repeats that from the
  average.
* Scoring: the state is carried through the whole document.

Broadcast are the model, whose size is fixed, and the most frequent words of at most ``LONGEST_WORD`` bytes: those
that are symbols, and of the others at most ``local_words``. The counts of all other words stay in a table; the other
words of documents are joined with it.

Null and empty texts are the end alone. A null doc_id counts as empty text for the checksum. Repeated
rows are learned from and scored each. Words of equal count are ordered by their bytes. With nothing to learn from
all tokens are unknown and have the same probability. Other columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ebbline.llm import gru
from ebbline.llm.arrow import once_per_worker, slices
from ebbline.llm.text import plain
from ebbline.session import stage

END, OTHER = 0, 1
# A task's counts are handed on and started anew when they are of so many words.
MOST_COUNTED = 400_000
# Text that is laid out in lanes at a time: enough to keep all lanes busy next to a long document.
SLICE_BYTES = 32_000_000
# Text that is split at a time: words take several times the memory of their text.
SPLIT_BYTES = 4_000_000
# Tokens that a learner lays out in lanes at a time, and that are counted at a time.
LAID_TOKENS = 1_000_000
# Average weights of so many learners at a time.
GROUP = 32
# Longer words are neither symbols nor broadcast.
LONGEST_WORD = 256


@dataclass(frozen=True)
class LmOptions:
    # Words that are symbols of the network.
    vocabulary: int = 1022
    # Other words whose counts are broadcast; an upper bound, a few MB.
    local_words: int = 200_000
    rounds: int = 1
    # Tokens that a learner gets, about; with fewer it works in fewer lanes, so that it still makes so many updates.
    learner_tokens: int = 8_000_000
    least_updates: int = 900
    folds: int = 7
    held_out_fold: int = 2
    gru: gru.GruOptions = gru.GruOptions()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, and how many each text has.

    Both functions work on bytes and know just the ASCII letters and the six ASCII spaces.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, owners = parts.flatten(), pc.list_parent_indices(parts).to_numpy()
    # Spaces at either end of a text leave an empty part there.
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), np.bincount(owners[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


def held_out(options: LmOptions) -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(key), F.lit(options.folds)) == options.held_out_fold


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    for whole in batches:
        for batch in slices(whole, "text", SPLIT_BYTES):
            yield batch.column("text")


COUNTED = pa.schema([("token", pa.string()), ("c", pa.int64())])


def count_words(texts: DataFrame) -> DataFrame:
    """(token, c) over the column ``text``."""

    def added(held: pa.Table, waiting: list[pa.Array]) -> pa.Table:
        found = pc.value_counts(pa.chunked_array(waiting, pa.string()))
        fresh = pa.table([found.field("values"), found.field("counts")], COUNTED)
        both = pa.concat_tables([held, fresh]) if held.num_rows else fresh
        return both.group_by("token").aggregate([("c", "sum")]).rename_columns(COUNTED.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = COUNTED.empty_table(), []
        for texts_ in _texts(batches):
            waiting.append(split_words(texts_)[0])
            if sum(map(len, waiting)) >= LAID_TOKENS:
                held, waiting = added(held, waiting), []
                if held.num_rows > MOST_COUNTED:
                    yield from held.to_batches()
                    held = COUNTED.empty_table()
        yield from added(held, waiting).to_batches()

    return texts.select("text").mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """What every task needs to know: the frequent words' counts, and the totals over all words."""

    # By frequency: words with their counts, the network's symbols first.
    words: list[tuple[bytes, int]]
    symbols: int
    documents: int
    # Over all words: occurrences and number of distinct ones.
    occurrences: int
    distinct: int

    @property
    def train_tokens(self) -> int:
        return self.occurrences + self.documents

    @property
    def base_unit(self) -> float:
        """log10 of the base model's denominator: N + 1 * (V + 1)."""
        return math.log10(self.train_tokens + self.distinct + (self.documents > 0) + 1)

    @property
    def other(self) -> tuple[int, int]:
        """Occurrences and distinct number of the words that are no symbols."""
        mine = self.words[: self.symbols]
        return self.occurrences - sum(c for _, c in mine), self.distinct - len(mine)

    @property
    def other_unit(self) -> float:
        return math.log10(sum(self.other) + 1)

    def symbol_counts(self) -> np.ndarray:
        return np.array([self.documents, self.other[0], *[c for _, c in self.words[: self.symbols]]], float)


def most_frequent(counts: DataFrame, documents: int, options: LmOptions) -> Vocabulary:
    """The symbols, and the words above the lowest count for which there are at most ``local_words``.

    That count comes from a histogram of counts in eighths of powers of two, a few hundred rows.
    """
    step = F.floor(F.log2("c") * 8)
    short = F.octet_length("token") <= LONGEST_WORD
    rows = counts.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("c").alias("occurrences"), F.min("c").alias("least"),
        F.count_if(short).alias("short"),
    )
    bars = sorted(rows.collect(), key=lambda r: -r["step"])
    least, room = None, options.local_words
    for bar in bars:
        room -= bar["short"]
        if room < 0:
            break
        least = bar["least"]
    known = counts.where(short)
    top = known.orderBy(F.desc("c"), "token").limit(options.vocabulary).collect()
    chosen = known.where(F.col("c") >= least).collect() if least is not None else []
    words = sorted({(r["token"].encode(), r["c"]) for r in (*top, *chosen)}, key=lambda w: (-w[1], w[0]))
    return Vocabulary(
        words,
        len(top),
        documents,
        sum(r["occurrences"] for r in bars),
        sum(r["words"] for r in bars),
    )


class _Coder:
    """Numbers and symbols of words, and log10(c + 1) by number; the last number is that of words not broadcast."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = pa.array([word for word, _ in vocabulary.words], pa.binary()).cast(pa.string())
        # A table of the symbols alone stays in the processor's cache, which is all that training looks up.
        self.symbol_words = self.words.slice(0, vocabulary.symbols)
        self.logs = np.log10([*[c + 1.0 for _, c in vocabulary.words], 1.0])
        self.symbols = np.full(len(vocabulary.words) + 1, OTHER, np.int32)
        self.symbols[: vocabulary.symbols] = np.arange(vocabulary.symbols) + OTHER + 1

    def numbers(self, words: pa.Array) -> np.ndarray:
        return _places(words, self.words)

    def code(self, texts: pa.Array) -> list[np.ndarray]:
        """The texts as symbols, each with its end."""
        words, sizes = split_words(texts)
        symbols = self.symbols[: len(self.symbol_words) + 1].copy()
        symbols[-1] = OTHER
        return with_ends(symbols[_places(words, self.symbol_words)], sizes)


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Places of words among the known ones; of other words their number."""
    return pc.fill_null(pc.index_in(words, known), len(known)).to_numpy(zero_copy_only=False)


def with_ends(symbols: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The symbols of texts of the given sizes, cut, each with its end."""
    stops = np.cumsum(sizes)
    return np.split(np.insert(symbols, stops, np.int32(END)), (stops + np.arange(1, len(sizes) + 1))[:-1])


WEIGHTS = pa.schema([("part", pa.int64()), ("tokens", pa.int64()), ("weights", pa.binary())])
WEIGHTS_DDL = "part long, tokens long, weights binary"


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a group of tasks: their weights averaged by tokens, in the order of the tasks."""
    rows, total = rows.sort_values("part"), rows["tokens"].sum()
    summed = sum(np.frombuffer(w, np.float32).astype(np.float64) * n for w, n in zip(rows["weights"], rows["tokens"]))
    made = (summed / total).astype(np.float32).tobytes()
    return pd.DataFrame({"part": [rows["group"].iloc[0]], "tokens": [total], "weights": [made]})


def _averaged(trained: DataFrame, like: gru.Weights) -> gru.Weights:
    """Weights averaged by tokens, level by level, at most ``GROUP`` rows in a task at once."""
    while trained.count() > 1:
        grouped = trained.withColumn("group", F.floor(F.col("part") / GROUP)).groupBy("group")
        trained = stage(grouped.applyInPandas(_mean, WEIGHTS_DDL), "lm-weights")
    row = trained.first()
    return gru.unpack(bytes(row["weights"]), like) if row else like


def train(learned: DataFrame, vocabulary: Vocabulary, options: LmOptions) -> gru.Weights:
    """A network trained on all of (doc_id, text), the same for any partitions of the rows."""
    context = learned.sparkSession.sparkContext
    weights = gru.initial(vocabulary.symbol_counts(), options.gru)
    shared = context.broadcast(vocabulary)
    key = uuid.uuid4().hex
    learners = max(1, math.ceil(vocabulary.train_tokens / options.learner_tokens))
    each = vocabulary.train_tokens // learners
    lanes = min(options.gru.lanes, max(16, each // (options.least_updates * options.gru.window)))
    settings = replace(options.gru, lanes=lanes)
    dealt = learned.select("text", F.xxhash64("doc_id", "text").alias("deal"))
    dealt = dealt.repartitionById(learners, F.pmod("deal", F.lit(learners)).cast("int"))
    dealt = dealt.sortWithinPartitions("deal", "text").select("text")
    for _ in range(options.rounds):
        start = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = once_per_worker("lm", key, lambda: _Coder(shared.value))
            trainer, coded, size = gru.Trainer(start.value, END, settings), [], 0
            for texts in _texts(batches):
                for document in coder.code(texts):
                    coded.append(document)
                    size += len(document)
                    if size >= LAID_TOKENS:
                        trainer.learn(coded)
                        coded, size = [], 0
            trainer.learn(coded)
            if trainer.tokens:
                row = {
                    "part": TaskContext.get().partitionId(),
                    "tokens": trainer.tokens,
                    "weights": gru.pack(trainer.weights),
                }
                yield pa.RecordBatch.from_pylist([row], WEIGHTS)

        trained = stage(dealt.mapInArrow(run, WEIGHTS_DDL), "lm-weights")
        weights = _averaged(trained, weights)
    return weights


SCORED = pa.schema(
    [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()),
     ("rare", pa.list_(pa.string())), ("times", pa.list_(pa.int32()))]
)
SCORED_TYPE = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("model", T.DoubleType()),
        T.StructField("rare", T.ArrayType(T.StringType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
    ]
)


def _partly_scored(rows: DataFrame, vocabulary: Vocabulary, weights: gru.Weights, options: LmOptions) -> DataFrame:
    """The columns besides ``text``, and scores as far as the broadcast words go.

    The other words are listed as ``rare`` and scored as if they had never been seen.
    """
    context = rows.sparkSession.sparkContext
    shared, model, key = context.broadcast(vocabulary), context.broadcast(weights), uuid.uuid4().hex
    rest = [field for field in rows.schema if field.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once_per_worker("lm", key, lambda: _Coder(shared.value))
        base_unit, other_unit, learned = shared.value.base_unit, shared.value.other_unit, shared.value.documents
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                coded, out = [], []
                for texts in _texts(iter([batch])):
                    words, sizes = split_words(texts)
                    numbers = coder.numbers(words)
                    symbols, logs = coder.symbols[numbers], coder.logs[numbers]
                    unknown = numbers == len(coder.words)
                    for start, size in zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist()):
                        mine = slice(start, start + size)
                        rare = Counter(words.take(np.flatnonzero(unknown[mine]) + start).to_pylist())
                        is_other = symbols[mine] == OTHER
                        out.append(
                            {
                                "n_tokens": size + 1,
                                "n_known": size - sum(rare.values()) + (learned > 0),
                                "base": float(logs[mine].sum()) + math.log10(learned + 1) - (size + 1) * base_unit,
                                "model": float(logs[mine][is_other].sum()) - int(is_other.sum()) * other_unit,
                                "rare": list(rare),
                                "times": list(rare.values()),
                            }
                        )
                    coded += with_ends(symbols, sizes)
                for row, value in zip(out, gru.score(model.value, coded, END, options.gru) / math.log(10)):
                    row["model"] += float(value)
                made = pa.RecordBatch.from_pylist(out, SCORED)
                named = [batch.column(field.name) for field in rest]
                yield pa.RecordBatch.from_arrays([*named, *made.columns], [*[f.name for f in rest], *SCORED.names])

    return rows.mapInArrow(run, T.StructType([*rest, *SCORED_TYPE]))


def score_documents(docs: DataFrame, options: LmOptions = LmOptions()) -> DataFrame:
    """One row per document: its tokens, the base score and the model's log10 probability."""
    rows = docs.select("doc_id", held_out(options).alias("held_out"), plain(F.col("text")).alias("text"))
    learned = rows.where("NOT held_out")
    counts = stage(count_words(learned), "lm-counts")
    vocabulary = most_frequent(counts, learned.count(), options)
    weights = train(learned, vocabulary, options)
    numbered = rows.withColumn("node", F.monotonically_increasing_id())
    kept = stage(_partly_scored(numbered, vocabulary, weights, options), "lm-scores")
    pairs = kept.select("node", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    found = pairs.select("node", F.col("r.rare").alias("token"), F.col("r.times").alias("times")).join(counts, "token")
    added = found.groupBy("node").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs")
    )
    late = F.coalesce("logs", F.lit(0.0))
    return kept.join(added, "node", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + late).alias("base_score"),
        (F.col("model") + late).alias("score"),
    )
