"""Token counts under a unigram vocabulary, without the tokens themselves.

Spaces become the marker ``▁``; a text gets one in front unless it starts with one, and every marker
starts a new word. Inside a word, an Aho-Corasick automaton enumerates the pieces that end at each
character, and dynamic programming carries only the best score and the number of pieces up to there.
The rules are those of the public unigram tokenizers, ties included: of two ways with the same score
the one whose last piece starts earlier wins; a character without a piece of its own costs the worst
score less 10; it counts as its UTF-8 bytes where the vocabulary has byte pieces, and otherwise a run
of such characters counts as one.

Scores are added as doubles, so a word's result does not depend on what stands before it and short
words are remembered per worker, up to ``REMEMBERED``. Null and empty texts count 0. Texts may be of any length.
Repeated rows are counted again. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from ebbline.llm.arrow import once_per_worker, slices

REMEMBERED = 300_000
LONGEST_REMEMBERED = 48
MARKER = "▁"
# Fixed value of the public unigram tokenizers: what an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0


class Counter(dict):
    """(pieces, score) of a word without its marker; computes what is missing and starts anew when full."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        # Of pieces given twice the last one holds.
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        known = {piece for piece, _ in pieces}
        self.bytes = all(f"<0x{byte:02X}>" in known for byte in range(256))

    def __missing__(self, word: str) -> tuple[int, float]:
        result = self.best(MARKER + word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = result
        return result

    def best(self, word: str) -> tuple[int, float]:
        size = len(word)
        score, count, open_run = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        found = self.automaton.iter(word) if len(self.automaton) else iter(())
        end, piece = next(found, (size, None))
        for at in range(size):
            best, pieces, run, single = None, 0, False, False
            # Matches come longest first, that is by ascending start, so only a better score replaces.
            while end == at:
                length, own = piece
                start = at + 1 - length
                reached = score[start] + own
                if best is None or reached > best:
                    best, pieces = reached, count[start] + 1
                single = single or length == 1
                end, piece = next(found, (size, None))
            if not single:
                reached = score[at] + self.unknown
                if best is None or reached > best:
                    best, run = reached, True
                    pieces = count[at] + (len(word[at].encode()) if self.bytes else not open_run[at])
            score[at + 1], count[at + 1], open_run[at + 1] = best, int(pieces), run
        return count[size], score[size]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = text.replace(" ", MARKER)
        words = marked.split(MARKER)
        found = [self[word] for word in (words[1:] if marked.startswith(MARKER) else words)]
        return sum(n for n, _ in found), sum(s for _, s in found)


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, by id."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], text: str = "text") -> DataFrame:
    """doc_id, n_tokens and the score of the best segmentation, a row for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    key = hash(tuple(pieces))
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once_per_worker("unigram", key, lambda: Counter(shared.value))
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, scores = zip(*map(counter.text, batch.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
                    names=schema.names,
                )

    return docs.selectExpr("doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(run, schema)
