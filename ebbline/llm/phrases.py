"""Phrase collocation mining with double-array tries of Apriori-safe candidates.

A phrase can only be frequent if its parts are. So candidates are found level by level, each a pass over the
texts that keeps 64-bit hashes, not phrases:

1. words are counted exactly;
2. runs of two frequent words are counted by hash, then runs of three whose halves are frequent. What is
   frequent one level below is known to the tasks as a bitmap of fixed size; a bit set by chance lets a few
   more runs through and loses none;
3. the phrases behind the hashes that reached the threshold are gathered.

Then the exact count. Candidates are cut by the hash of their first two words into blocks of at most ``TRIE_PHRASES``
phrases or so and ``TRIE_BYTES`` of text. A block becomes a trie over its words' numbers in two arrays: from state s the
digit d leads to base[s] + d if check holds s there. One pass over the texts sends every run that may hold a candidate to
the block of its first two words, equal runs of a slice once with their number, so that the texts are read once
however many candidates there are, and a task holds one trie. There numpy moves many runs on at the same time, level by
level; the states that accept are counted.

Counts are per language. Scores are exact decimals. A phrase inside a longer candidate that is at least half as
frequent goes. The best of each language are found in parts first, so that no task ranks all of them.

Null texts are empty, a null language is ``und``, and both texts and words may be of any length. Repeated rows
count each time. Equal scores and counts are ordered by the bytes of the phrase. Empty tables give no
rows. Other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from ebbline.llm.arrow import map_arrow, slices
from ebbline.session import stage

# What ends a piece, and what bytes are turned into: ends of pieces into line feeds, tabs into blanks, and
# ASCII letters into small ones. Only ASCII is touched: every byte of another character is above it.
ENDS = b".,;:!?\x0b\x0c\r\n"
LINE, BLANK = b"\n", b" "
TO_LINES = bytes(10 if value in ENDS else 32 if value == 9 else bytes([value]).lower()[0] for value in range(256))
LONGEST = 3
# Bits that tell the tasks which runs are frequent, a power of two.
FILTER_BITS = 1 << 25
# A block of candidates: so many phrases and bytes of text, on average; and the least number of blocks, so that those of
# a small table are dealt out as well.
TRIE_PHRASES = 100_000
TRIE_BYTES = 8_000_000
TRIES = 64
# Runs that a trie counts at a time, or more.
COUNTED_RUNS = 262_144
# Bytes of text that a task splits at a time.
SLICE_BYTES = 6_000_000
# Parts of a language whose best are found before they meet.
PARTS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
# Digits of a word's number in the trie.
DIGITS = 3
# Nodes with more children are placed one by one; rounds in which the others are drawn for.
WIDE = 16
ROUNDS = 20


@dataclass(frozen=True)
class Tokens:
    """Texts of one language as numbers of ``words``, with -1 between pieces."""

    lang: str
    words: pa.Array
    at: np.ndarray


def tokens(batch: pa.RecordBatch) -> Iterator[Tokens]:
    """Per language the words of the batch's texts, lower-cased; nothing where there are none."""
    by_lang: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
        by_lang.setdefault(lang, []).append(text)
    for lang, texts in by_lang.items():
        lines = LINE.join(texts).translate(TO_LINES)
        signs = np.frombuffer(lines, np.uint8)
        line = signs == LINE[0]
        inside = ~(line | (signs == BLANK[0]))
        starts, lasts = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        lasts[:-1] &= ~inside[1:]
        lengths = np.flatnonzero(lasts) + 1 - np.flatnonzero(starts)
        if not len(lengths):
            continue
        # Words follow each other without anything between them, so that no object is made per word.
        offsets = np.append(0, lengths.cumsum()).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(lines.translate(None, LINE + BLANK))]
        coded = pa.Array.from_buffers(pa.binary(), len(lengths), buffers).dictionary_encode()
        ends = line[np.flatnonzero(line | starts)]
        at = np.full(len(ends), -1)
        at[~ends] = coded.indices.to_numpy(zero_copy_only=False)
        yield Tokens(lang, coded.dictionary, at)


def _each(docs: DataFrame, make: Callable[[Tokens], pa.RecordBatch | None], kind: str) -> DataFrame:
    """What ``make`` returns for the words of every slice of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                for part in tokens(batch):
                    yield make(part)

    return docs.mapInArrow(run, kind)


def _listed(words: pa.Array) -> list[bytes]:
    """Much faster than ``to_pylist``."""
    return words.to_numpy(zero_copy_only=False).tolist()


def word_hashes(part: Tokens) -> np.ndarray:
    """Of every distinct word; the same as Spark's xxhash64(lang, word), read as unsigned."""
    seed, digest = xxhash.xxh64_intdigest(part.lang.encode(), 42), xxhash.xxh64_intdigest
    return np.fromiter(map(digest, _listed(part.words), repeat(seed)), np.uint64, len(part.words))


def run_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words from every position on, of no use where a piece ends inside."""
    words = hashes[at]
    found = words[: max(0, len(words) - size + 1)].copy()
    for step in range(1, size):
        found = (found ^ found >> np.uint64(31)) * MIX + words[step : step + len(found)]
    return found ^ found >> np.uint64(29)


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """A bit for every value of the column ``key``; at most ``FILTER_BITS`` / 64 rows reach the driver."""
    bit = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = hashes.groupBy(F.shiftright(bit, 6).alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(key & 63L AS INT))")).alias("bits")
    )
    found = words.toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bitmap


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of all words."""

    def make(part: Tokens) -> pa.RecordBatch:
        counts = np.bincount(part.at[part.at >= 0], minlength=len(part.words))
        used = np.flatnonzero(counts)
        words = part.words.take(pa.array(used)).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([part.lang] * len(used), pa.string()), words, pa.array(counts[used])], ["lang", "word", "f"]
        )

    return _each(docs, make, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _safe(part: Tokens, bitmap: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of runs of ``size`` words whose two runs of one word less are marked, and all runs' hashes."""
    hashes = word_hashes(part)
    shorter = _held(bitmap, run_hashes(hashes, part.at, size - 1)) if size > 2 else _held(bitmap, hashes)[part.at]
    inside = _inside(part.at, size - 1)
    shorter &= inside
    both = shorter[:-1] & shorter[1:] if len(shorter) > 1 else np.zeros(0, bool)
    return np.flatnonzero(both), run_hashes(hashes, part.at, size)


def _inside(at: np.ndarray, size: int) -> np.ndarray:
    """Whether the run of ``size`` words from a position on lies in one piece."""
    count = max(0, len(at) - size + 1)
    inside = np.ones(count, bool)
    for step in range(size):
        inside &= at[step : step + count] >= 0
    return inside


def frequent_runs(docs: DataFrame, shorter: np.ndarray, size: int, least: int) -> DataFrame:
    """(key): hashes of the runs of ``size`` words found ``least`` times or more; ``shorter`` marks their parts."""
    sent = docs.sparkSession.sparkContext.broadcast(shorter)  # FILTER_BITS bits

    def make(part: Tokens) -> pa.RecordBatch:
        places, hashes = _safe(part, sent.value, size)
        keys, counts = np.unique(hashes[places], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "f"])

    counted = _each(docs, make, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))
    found = stage(counted.where(F.col("f") >= least).select("key"), "phrase-keys")
    sent.destroy()
    return found


def gather(docs: DataFrame, marked: dict[int, np.ndarray]) -> DataFrame:
    """(lang, phrase, size, key, pair) of the distinct runs whose hash is marked, by size; pair: hash of the first two words."""
    sent = docs.sparkSession.sparkContext.broadcast(marked)

    def make(part: Tokens) -> pa.RecordBatch:
        hashes, columns = word_hashes(part), []
        pairs = run_hashes(hashes, part.at, 2)
        for size, bitmap in sent.value.items():
            keys = run_hashes(hashes, part.at, size)
            places = np.flatnonzero(_inside(part.at, size) & _held(bitmap, keys))
            # Told apart by the words themselves, for hashes may be equal.
            runs = part.at[places]
            for step in range(1, size):
                _, first, runs = np.unique(runs * len(hashes) + part.at[places + step], return_index=True, return_inverse=True)
            texts = [part.words.take(pa.array(part.at[places[first] + step])).cast(pa.string()) for step in range(size)]
            phrases = pc.binary_join_element_wise(*texts, " ")
            found = places[first]
            columns.append((phrases, np.full(len(first), size, np.int32), keys[found].view(np.int64), pairs[found].view(np.int64)))
        phrases, *numbers = zip(*columns)
        phrases = pa.chunked_array(phrases).combine_chunks()
        langs = pa.array([part.lang] * len(phrases), pa.string())
        numbers = [pa.array(np.concatenate(cells)) for cells in numbers]
        return pa.RecordBatch.from_arrays([langs, phrases, *numbers], ["lang", "phrase", "size", "key", "pair"])

    return _each(docs, make, "lang string, phrase string, size int, key long, pair long").distinct()


@dataclass(frozen=True)
class Trie:
    """A double array. A word is a number, from 1 by language, and a number ``DIGITS`` digits of eight bits.

    From state s the digit d leads to base[s] + d where check holds s; state 0 is the root. ``first`` is the state
    after each word at the start of a phrase, or -1; ``accept`` holds the number of the phrase that ends in a
    state, or -1, and ``phrases`` their ids.
    """

    words: dict[str, tuple[int, pa.Array]]
    base: np.ndarray
    check: np.ndarray
    first: np.ndarray
    accept: np.ndarray
    phrases: np.ndarray

    def numbers(self, part: Tokens) -> np.ndarray:
        """The trie's number of every distinct word, 0 where it has none, and last for what ends a piece."""
        if part.lang not in self.words:
            return np.zeros(len(part.words) + 1, np.int64)
        first, known = self.words[part.lang]
        found = pc.index_in(part.words, known).fill_null(-first).to_numpy(zero_copy_only=False)
        return np.append(found.astype(np.int64) + first, 0)

    def advance(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The states that words lead to, -1 where there is none."""
        end = np.full(len(state), -1, np.int64)
        at = np.flatnonzero((state >= 0) & (number > 0))
        state, number = state[at], number[at]
        for digit in range(DIGITS):
            slot = self.base[state] + (number >> 8 * digit & 255)
            moved = self.check[slot] == state
            at, state, number = at[moved], slot[moved], number[moved]
        end[at] = state
        return end

    def count(self, part: Tokens, start: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
        """How often each phrase occurs, overlaps included; they begin at some of the positions ``start``.

        What begins there counts once, or so many ``times``.
        """
        numbers, at = self.numbers(part), part.at
        total = np.zeros(len(self.phrases), np.int64)
        # All positions take their first word at once; those that are still in the trie then their next.
        state = self.first[numbers[at[start]]]
        times = np.ones(len(start), np.int64) if times is None else times
        for step in range(1, LONGEST):
            alive = (state >= 0) & (start + step < len(at))
            start, times = start[alive], times[alive]
            state = self.advance(state[alive], numbers[at[start + step]])
            ended = np.flatnonzero(state >= 0)
            phrase = self.accept[state[ended]]
            np.add.at(total, phrase[phrase >= 0], times[ended][phrase >= 0])
        return total


def build_trie(phrases: pa.Table) -> Trie:
    """A trie of the rows (id, lang, phrase). No object is made per phrase, for the driver builds it."""
    lang = phrases.column("lang").combine_chunks().dictionary_encode()
    split = pc.split_pattern(phrases.column("phrase").combine_chunks(), " ")
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    word = split.flatten().dictionary_encode()
    spoken = np.repeat(lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes)
    # Words are numbered by language, so that a word of two languages is two.
    codes, number = np.unique(spoken * len(word.dictionary) + word.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    most = len(codes) + 1
    known = {}
    for code, name in enumerate(lang.dictionary.to_pylist()):
        start, end = np.searchsorted(codes, [code * len(word.dictionary), (code + 1) * len(word.dictionary)])
        known[name] = int(start) + 1, word.dictionary.take(pa.array(codes[start:end] % len(word.dictionary))).cast(pa.binary())
    runs = np.zeros((len(sizes), LONGEST), np.int64)
    runs[np.repeat(np.arange(len(sizes)), sizes), _within_group(sizes)] = number + 1

    # A node is a node before it and a digit; the nodes of one level are numbered after those before.
    parents, digits, nodes = [], [], 1
    node, last = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
    for step in range(LONGEST):
        rows = np.flatnonzero(runs[:, step])
        for digit in range(DIGITS):
            codes, inverse = np.unique(node[rows] << 8 | runs[rows, step] >> 8 * digit & 255, return_inverse=True)
            parents.append(codes >> 8)
            digits.append(codes & 255)
            node[rows] = nodes + inverse
            nodes += len(codes)
        last[rows] = node[rows]
    slot, base, check = place(np.concatenate(parents), np.concatenate(digits))
    accept = np.full(len(check), -1, np.int32)
    accept[slot[last]] = np.arange(len(runs))
    ids = phrases.column("id").to_numpy()
    trie = Trie(known, base, check, np.zeros(0, np.int64), accept, ids)
    everything = np.arange(most)
    return replace(trie, first=trie.advance(np.zeros(most, np.int64), everything))


def place(parent: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all nodes, and the arrays base and check.

    Edge e leads from node ``parent[e]`` by ``digit[e]`` to node e + 1. Nodes with many children are placed first,
    each where a few draws or else the free end of the arrays have room; those with a few children are drawn for
    together, round by round; those with one child fill what is left.
    """
    nodes, draw = len(parent) + 1, np.random.default_rng(1)
    order = np.argsort(parent, kind="stable")
    owners, starts, counts = np.unique(parent[order], return_index=True, return_counts=True)
    base_of = np.zeros(nodes, np.int64)
    taken = np.zeros(256 + 2 * nodes, bool)
    taken[0] = True
    end = 1  # nothing is taken from here on

    def room(size: int) -> None:
        nonlocal taken
        if size > len(taken):
            taken = np.append(taken, np.zeros(max(size - len(taken), len(taken) // 2), bool))

    def settle(at: int, base: int) -> None:
        nonlocal end
        taken[base + digit[order[starts[at] : starts[at] + counts[at]]]] = True
        base_of[owners[at]] = base
        end = max(end, base + 256)

    def at_end(left: np.ndarray) -> None:
        for at in left:
            room(end + 256)
            settle(at, end)

    wide = np.flatnonzero(counts > WIDE)
    for at in wide[np.argsort(-counts[wide], kind="stable")]:
        children = digit[order[starts[at] : starts[at] + counts[at]]]
        bases = draw.integers(0, end, 8)
        free = ~taken[bases[:, None] + children].any(axis=1) if end + 256 <= len(taken) else np.zeros(8, bool)
        if free.any():
            settle(at, int(bases[free.argmax()]))
        else:
            at_end([at])
    left = np.flatnonzero((counts > 1) & (counts <= WIDE))
    area = max(end, nodes)
    room(area + 256)
    for _ in range(ROUNDS):
        if not len(left):
            break
        bases = draw.integers(0, area, len(left))
        rows = np.repeat(np.arange(len(left)), counts[left])
        slots = bases[rows] + digit[order[np.repeat(starts[left], counts[left]) + _within_group(counts[left])]]
        # A draw fails where a slot is taken, or wanted by an earlier one of the same round.
        claim = np.full(len(taken), len(left), np.int32)
        np.minimum.at(claim, slots, rows.astype(np.int32))
        bad = np.zeros(len(left), bool)
        bad[rows[taken[slots] | (claim[slots] != rows)]] = True
        taken[slots[~bad[rows]]] = True
        base_of[owners[left[~bad]]] = bases[~bad]
        left = left[bad]
    end = max(end, int(np.flatnonzero(taken)[-1]) + 1)
    at_end(left)
    single = np.flatnonzero(counts == 1)
    room(256 + len(single) + int(taken.sum()) + 1)
    free = np.flatnonzero(~taken[256:])[: len(single)] + 256
    base_of[owners[single]] = free - digit[order[starts[single]]]
    slot = np.zeros(nodes, np.int64)
    slot[1:] = base_of[parent] + digit
    # A step from any state stays inside the arrays; a node without children leads nowhere.
    size = int(max(slot.max(), base_of.max())) + 257
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    base[slot] = base_of
    check[slot[1:]] = slot[parent]
    return slot, base, check


def _within_group(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each group."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


# What a row of a block holds, pickled: its trie, which comes first, or runs of words.
TRIE, RUNS = 0, 1
OF_BLOCK = "block int, kind int, data binary"


def _block_of(pairs: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a hash of two words; the same as in ``count_phrases``."""
    return ((pairs >> np.uint64(11)) % np.uint64(blocks)).astype(np.int32)


def dealt_runs(part: Tokens, marked: dict[int, np.ndarray], blocks: int) -> pa.RecordBatch:
    """The runs that may hold a candidate, by the block of their first two words: equal ones once, with their number.

    A run is as long as ``marked`` has its hashes, by size. It begins where its first two words are marked.
    """
    hashes = word_hashes(part)
    pairs = run_hashes(hashes, part.at, 2)
    places = np.flatnonzero(_inside(part.at, 2) & _held(marked[2], pairs))
    columns = [part.at[places], part.at[places + 1]]
    alive = np.ones(len(places), bool)
    for size in range(3, LONGEST + 1):
        known = np.zeros(len(part.at), bool)
        held = _inside(part.at, size) & _held(marked[size], run_hashes(hashes, part.at, size))
        known[: len(held)] = held
        alive &= known[places]
        # The last word that there is stands for one that is not, which is not looked at.
        columns.append(np.where(alive, part.at[np.minimum(places + size - 1, len(part.at) - 1)], -1))
    runs, first, times = columns[0], np.arange(len(places)), np.ones(len(places), np.int64)
    for column in columns[1:]:
        code = runs * (len(hashes) + 1) + column + 1
        _, first, runs, times = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    # Words of a run, and -1 to end it.
    at = np.stack([*[column[first] for column in columns], np.full(len(first), -1)], 1)
    block = _block_of(pairs[places[first]], blocks)
    order = np.argsort(block, kind="stable")
    block, at, times = block[order], at[order], times[order]
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    data = []
    for start, end in zip(starts, [*starts[1:], len(block)]):
        used, own = np.unique(at[start:end].ravel(), return_inverse=True)
        words = BLANK.join(_listed(part.words.take(pa.array(used[1:]))))
        kind = np.int16 if len(used) < 2**15 else np.int32
        most = np.uint16 if times[start:end].max() < 2**16 else np.int64
        data.append(pickle.dumps((part.lang, words, (own - 1).astype(kind), times[start:end].astype(most))))
    cells = [pa.array(block[starts]), pa.array(np.full(len(starts), RUNS, np.int32)), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(cells, ["block", "kind", "data"])


def _trie_row(candidates: pa.Table) -> pa.Table:
    """The trie of one block's (id, lang, phrase)."""
    data = pickle.dumps(build_trie(candidates.select(["id", "lang", "phrase"])))
    cells = [candidates.column("block").slice(0, 1), pa.array([TRIE], pa.int32()), pa.array([data], pa.binary())]
    return pa.table(dict(zip(("block", "kind", "data"), cells)))


class _Count:
    """The counts of one block's phrases. Runs wait, by language, until there are many."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.total = np.zeros(len(trie.phrases), np.int64)
        self.waiting: dict[str, list[tuple]] = {}

    def take(self, lang: str, words: bytes, at: np.ndarray, times: np.ndarray) -> None:
        waiting = self.waiting.setdefault(lang, [])
        waiting.append((pa.array(words.split(BLANK), pa.binary()), at.astype(np.int64), times.astype(np.int64)))
        if sum(len(times) for _, _, times in waiting) >= COUNTED_RUNS:
            self.settle(lang)

    def settle(self, lang: str) -> None:
        words, ats, times = zip(*self.waiting.pop(lang))
        # Each has words of its own, which follow those before.
        before = np.cumsum([0, *map(len, words)])
        at = np.concatenate([np.where(at < 0, -1, at + first) for at, first in zip(ats, before)])
        part, start = Tokens(lang, pa.concat_arrays(words), at), np.arange(0, len(at), LONGEST + 1)
        self.total += self.trie.count(part, start, np.concatenate(times))

    def found(self) -> pa.RecordBatch:
        for lang in list(self.waiting):
            self.settle(lang)
        some = self.total > 0
        return pa.RecordBatch.from_arrays([pa.array(self.trie.phrases[some]), pa.array(self.total[some])], ["id", "f"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, f) of the phrases of all blocks; rows ``OF_BLOCK`` come block by block, the trie first."""
    here, count = None, None
    for batch in batches:
        for block, kind, data in zip(batch.column("block").to_pylist(), batch.column("kind").to_pylist(), batch.column("data")):
            if kind == TRIE:
                if count is not None:
                    yield count.found()
                here, count = block, _Count(pickle.loads(data.as_buffer()))
            elif block == here:  # A block of runs that only seemed to hold a candidate has no trie.
                count.take(*pickle.loads(data.as_buffer()))
    if count is not None:
        yield count.found()


def count_phrases(docs: DataFrame, candidates: DataFrame, marked: dict[int, np.ndarray]) -> DataFrame:
    """(lang, phrase, size, f): exact counts of the candidates (lang, phrase, size, pair), in one pass over the texts.

    ``marked`` marks, by size, the hashes of all candidates.
    """
    size = F.octet_length("phrase") + F.octet_length("lang")
    rows, length = candidates.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    blocks = max(TRIES, -(-rows // TRIE_PHRASES), -(-(length or 0) // TRIE_BYTES))
    block = F.pmod(F.shiftrightunsigned("pair", 11), F.lit(blocks)).cast("int")
    numbered = stage(
        candidates.select(F.monotonically_increasing_id().alias("id"), "lang", "phrase", "size", block.alias("block")),
        "phrase-candidates",
    )
    sent = docs.sparkSession.sparkContext.broadcast(marked)  # two bitmaps of FILTER_BITS bits
    tries = numbered.select("id", "lang", "phrase", "block").groupBy("block").applyInArrow(_trie_row, OF_BLOCK)
    runs = _each(docs, lambda part: dealt_runs(part, sent.value, blocks), OF_BLOCK)
    parts = tries.unionByName(runs).repartition("block").sortWithinPartitions("block", "kind")
    counted = stage(map_arrow(parts, _counted, "id long, f long"), "phrase-counts")
    sent.destroy()
    return numbered.join(counted, "id").select("lang", "phrase", "size", "f")


def mine(docs: DataFrame, least: int = 10, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, word, f) of all words, and (lang, phrase, size, f) of the phrases found ``least`` times or more."""
    docs = docs.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
    )
    words = stage(count_words(docs), "phrase-words")
    frequent = words.where(F.col("f") >= least)
    marked, keys, shorter = {}, None, bitmap_of(frequent.select(F.xxhash64("lang", "word").alias("key")))
    for size in range(2, LONGEST + 1):
        found = frequent_runs(docs, shorter, size, least)
        marked[size] = shorter = bitmap_of(found)
        keys = found.withColumn("size", F.lit(size)) if keys is None else keys.unionByName(found.withColumn("size", F.lit(size)))
    candidates = stage(gather(docs, marked).join(keys, ["key", "size"], "left_semi"), "phrase-gathered")
    return words, stage(count_phrases(docs, candidates, marked).where(F.col("f") >= least), "phrases")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases with the parts l and r of their lowest-scoring cut and the score."""
    parts = words.select("lang", F.col("word").alias("part"), "f").unionByName(
        phrases.where(F.col("size") < LONGEST).select("lang", F.col("phrase").alias("part"), "f")
    )
    cell = F.split("phrase", " ")
    cuts = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cut = phrases.select("lang", "phrase", "size", F.col("f").alias("a"), cuts).select(
        "lang",
        "phrase",
        "size",
        "a",
        "k",
        F.concat_ws(" ", F.slice(cell, F.lit(1), F.col("k"))).alias("left"),
        F.concat_ws(" ", F.slice(cell, F.col("k") + 1, F.col("size"))).alias("right"),
    )
    both = cut.join(parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    both = both.join(parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = "(CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * 1000000BD) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    return (
        both.withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "size", "a")
        .agg(lowest)
        .select("lang", "phrase", "size", "a", "low.l", "low.r", "low.score")
    )


def without_parts(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """Phrases that do not lie in a longer one with at least ``percent`` of their count."""
    cell = F.split("phrase", " ")
    within = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1),"
        " i -> concat_ws(' ', slice(split(phrase, ' '), i, n)))))"
    )
    longer = phrases.where(F.size(cell) > 2).select("lang", F.explode(within).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    gone = F.coalesce(100 * F.col("longer") >= percent * F.col("a"), F.lit(False))
    return phrases.join(longer, ["lang", "phrase"], "left").where(~gone).drop("longer")


def best_phrases(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """Per language the ``top`` phrases by score, count and bytes: lang, rank, phrase, a, l, r, n, score."""
    words, phrases = mine(docs, least)
    kept = without_parts(scored(words.where(F.col("f") >= least), phrases)).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    in_part = F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))
    some = kept.withColumn("rank", in_part).where(F.col("rank") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order))
    best = some.withColumn("rank", rank).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
