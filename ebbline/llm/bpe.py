"""Byte-level BPE encoding and decoding by a file of merge ranks.

Every match of the splitting pattern is encoded on its own. Merges are taken in order of rank from a
queue whose buckets hold list positions, one bucket per rank; a hierarchical bitmap over the buckets
finds the next rank by looking for the first set bit of one word per level. Pairs wait in the queue only
while they rank below their neighbours. A merge changes only its neighbours' pairs, so entries that no
longer hold are left in the queue and skipped. That makes a pre-token of n bytes cost n log n steps at
worst, where rescanning after every merge costs n squared.

Texts are encoded row by row in Arrow batches; short pre-tokens are remembered per worker, up to
``REMEMBERED`` of them unless a caller has room for more. Ids are kept as one binary value per text: unsigned 32-bit, little-endian.

Null and empty texts have no ids. Texts and pre-tokens may be of any length. Pairs of equal rank are merged from the
left. Repeated rows are encoded again. An empty table gives no rows. Other columns pass unread; those that are called
like a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from ebbline.llm.arrow import once_per_worker, with_column, with_columns

REMEMBERED = 300_000
LONGEST_REMEMBERED = 48
DECODED_AT_ONCE = 1_000_000
BITS = 8
MASK = (1 << BITS) - 1
SET = [1 << bit for bit in range(1 << BITS)]


class RankQueue:
    """Positions by rank, lowest rank first and leftmost position first within a rank.

    Level 0 of the bitmap has a bit per rank, in words of 256 bits; every level above has a bit per
    word below. A bucket is a bare position while it holds only one, else a heap. The queue is empty
    again after use, so one serves any number of pre-tokens.
    """

    def __init__(self, ranks: int):
        self.buckets: dict[int, int | list[int]] = {}
        self.levels: list[list[int]] = []
        words = ranks
        while True:
            words = (words + MASK) >> BITS
            self.levels.append([0] * words)
            if words <= 1:
                break
        self.lowest, self.above, self.from_top = self.levels[0], self.levels[1:], self.levels[:0:-1]

    def push(self, rank: int, position: int) -> None:
        buckets = self.buckets
        if rank in buckets:
            held = buckets[rank]
            if type(held) is int:
                buckets[rank] = [held, position] if held < position else [position, held]
            else:
                heappush(held, position)
            return
        buckets[rank] = position
        word = rank >> BITS
        before = self.lowest[word]
        self.lowest[word] = before | SET[rank & MASK]
        if before:
            return
        for level in self.above:
            rank, word = word, word >> BITS
            before = level[word]
            level[word] = before | SET[rank & MASK]
            if before:
                return

    def pop(self) -> tuple[int, int]:
        word = 0
        for level in self.from_top:
            bits = level[word]
            word = word << BITS | (bits & -bits).bit_length() - 1
        bits = self.lowest[word]
        rest = bits & bits - 1
        rank = word << BITS | (bits ^ rest).bit_length() - 1
        held = self.buckets.pop(rank)
        if type(held) is not int:
            position = heappop(held)
            self.buckets[rank] = held if len(held) > 1 else held[0]
            return rank, position
        self.lowest[word] = rest
        if not rest:
            for level in self.above:
                index, word = word, word >> BITS
                left = level[word] ^ SET[index & MASK]
                level[word] = left
                if left:
                    break
        return rank, held


class Encoder:
    """Ids of texts and texts of ids, for one vocabulary. ``remembered`` is how many short pre-tokens are."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int | None = None):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.split_ascii = re.compile(ascii_pattern(pattern), re.ASCII).findall
        self.longest = max(map(len, ranks), default=0)
        # Above all ranks: that of a pair that is no piece.
        self.none = max(ranks.values(), default=0) + 1
        self.queue = RankQueue(self.none)
        self.starts, self.sizes, self.blob = _vocabulary_bytes(ranks)
        self.remembered = _Remembered(self, remembered or REMEMBERED)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        split = self.split_ascii if text.isascii() else self.split
        return b"".join(map(self.remembered.__getitem__, split(text)))

    def decode(self, packed: bytes | None) -> bytes:
        every, parts = np.frombuffer(packed or b"", "<u4"), []
        for at in range(0, len(every), DECODED_AT_ONCE):
            ids = every[at : at + DECODED_AT_ONCE]
            sizes = self.sizes[ids]
            # Every output byte's place in the vocabulary: its piece's start and its offset in the piece.
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + sizes, sizes)
            parts.append(self.blob[places].tobytes())
        return b"".join(parts)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        Only pairs that rank below their neighbours wait in the queue: the lowest of all is always one of them. A pair
        is pushed when a merge next to it leaves it so; one that is pushed twice is stale the second time.
        """
        ranks, longest, queue = self.ranks, self.longest, self.queue
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        size, none = len(piece), self.none
        if not size:
            return []
        # A node of the list is known by its first byte; it ends where the next one starts.
        following, previous = list(range(1, size + 2)), list(range(-1, size))
        rank_of, push, pop, buckets = ranks.get, queue.push, queue.pop, queue.buckets
        # The rank of the pair that starts at a node; the place after the last node is also that before the first.
        pair_rank = [rank_of(piece[node : node + 2], none) for node in range(size - 1)]
        pair_rank += none, none
        left = none
        for node in range(size - 1):
            rank = pair_rank[node]
            if rank < left and rank <= pair_rank[node + 1]:
                push(rank, node)
            left = rank
        while buckets:
            rank, node = pop()
            if pair_rank[node] != rank:
                continue
            gone = following[node]
            after = following[gone]
            following[node] = after
            previous[after] = node
            pair_rank[gone] = none
            # The two pairs that the merged piece is part of, then those beside them.
            own = none
            if after < size:
                end = following[after]
                if end - node <= longest:
                    own = rank_of(piece[node:end], none)
            pair_rank[node] = own
            before, left, outer = previous[node], none, none
            if before >= 0:
                if after - before <= longest:
                    left = rank_of(piece[before:after], none)
                pair_rank[before] = left
                beyond = previous[before]
                outer = pair_rank[beyond]
                if left < outer:
                    if left <= own:
                        push(left, before)
                elif outer < none and outer < pair_rank[previous[beyond]]:
                    push(outer, beyond)
            right = pair_rank[after]
            if own <= right:
                if own < left:
                    push(own, node)
            elif right <= pair_rank[following[after]]:
                push(right, after)
        ids, node = [], 0
        while node < size:
            ids.append(ranks[piece[node : following[node]]])
            node = following[node]
        return ids


def ascii_pattern(pattern: str) -> str:
    """The pattern for texts of ASCII alone, whose letters and numbers can be listed."""

    def listed(match: re.Match) -> str:
        if match[0].startswith("["):
            return match[0].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        return "[a-zA-Z]" if match[0] == r"\p{L}" else "[0-9]"

    return re.sub(r"\[[^\]]*\]|\\p\{[LN]\}", listed, pattern)


def _vocabulary_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of every rank's piece, and all pieces on end."""
    sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    ordered = sorted(ranks.items(), key=lambda item: item[1])
    for piece, rank in ordered:
        sizes[rank] = len(piece)
    blob = np.frombuffer(b"".join(piece for piece, _ in ordered), np.uint8)
    return np.cumsum(sizes) - sizes, sizes, blob


class _Remembered(dict):
    """Packed ids by pre-token; computes what is missing and forgets late ones when full."""

    def __init__(self, encoder: Encoder, most: int):
        super().__init__()
        self.encoder, self.most = encoder, most

    def __missing__(self, token: str) -> bytes:
        ids = self.encoder.merged(token.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                # Frequent pre-tokens are met early, so the later half makes room.
                for late in list(islice(reversed(self), self.most // 2)):
                    del self[late]
            self[token] = packed
        return packed


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 piece and its rank per line. Vocabularies are small and of fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines) if piece}


def _encoder(df: DataFrame, ranks: dict[bytes, int], pattern: str, remembered: int | None = None):
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    key = hash(frozenset(ranks.items())), pattern, remembered
    return lambda: once_per_worker("bpe", key, lambda: Encoder(shared.value, pattern, remembered))


def encode(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all of ``df``) and the packed ids of every whole text."""

    def make(encoder: Encoder, texts: list) -> pa.Array:
        return pa.array([encoder.encode(value) for value in texts], pa.binary())

    return with_column(df, ids, T.BinaryType(), text, _encoder(df, ranks, pattern), make, keep)


def decode(
    df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all of ``df``) and the bytes that the packed ids stand for."""

    def make(encoder: Encoder, packed: list) -> pa.Array:
        return pa.array([encoder.decode(value) for value in packed], pa.binary())

    return with_column(df, decoded, T.BinaryType(), ids, _encoder(df, ranks, "$^"), make, keep)


def digests(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    keep: list[str] | None = None,
    with_ids: bool = True,
    remembered: int | None = None,
) -> DataFrame:
    """``keep``, then n_tokens, ids, their SHA-256, and the SHA-256 of the bytes they decode to.

    Encoded and decoded in one pass of one worker, so that neither ids nor bytes travel only to be digested.
    ``remembered`` pre-tokens take some 150 bytes each of a worker's memory; they change no result.
    """
    fields = [
        T.StructField("n_tokens", T.LongType()),
        *[T.StructField("ids", T.BinaryType())] * with_ids,
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def make(encoder: Encoder, texts: list) -> list[pa.Array]:
        sizes, every, ids_digests, decoded_digests = [], [], [], []
        for value in texts:
            ids = encoder.encode(value)
            sizes.append(len(ids) // 4)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            decoded_digests.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            if with_ids:
                every.append(ids)
        packed = [pa.array(every, pa.binary())] * with_ids
        return [pa.array(sizes, pa.int64()), *packed, pa.array(ids_digests, pa.string()), pa.array(decoded_digests, pa.string())]

    return with_columns(df, fields, text, _encoder(df, ranks, pattern, remembered), make, keep)
