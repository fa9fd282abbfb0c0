"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as tokens, runs of letters, digits and underscores, case
folded. Runs of ``min_match`` tokens that occur in an item are seeds; a document's tokens are joined
with them, and only pairs of a document and an item that share a seed are looked at. Such a pair is
tiled: the longest matches that do not overlap are marked first, found by Karp-Rabin hashing of all
unmarked runs of the wanted length, and the wanted length shrinks down to ``min_match``. The marked
share of the item's tokens is its coverage; because tiles may lie in any order, an item whose
sentences were moved around is still covered. A document is contaminated if an item's coverage is at
least ``threshold``.

The benchmark is a stated set of queries. It is cut, by sums of its bytes, into blocks of at most
``BLOCK_BYTES`` of text (or one item, if that is longer), each broadcast in a pass of its own over the documents, so
its size is not limited by memory. What a pass hands on is the hits of the texts that have any, by a hash of the
text; neither texts nor other columns are written or shuffled, unless the hits of several blocks are too many to be
broadcast.

Items of fewer tokens than ``min_match`` have one seed, all their tokens in order; items without
tokens, null ones included, match nothing, and neither do null or empty texts. Items with the same id
are items of their own. Of matches of one length the one that is first in the item goes first, then the one that
is first in the text. Texts may be of any length; pairs of places inside two runs of one token are
not visited.
Repeated documents are judged each. Empty tables are fine. A column called like the result is replaced.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ebbline.llm.arrow import once_per_worker, with_column
from ebbline.llm.text import packed, plain
from ebbline.session import stage

BLOCK_BYTES = 16_000_000
# Room that an item takes besides its text, and shares that make up a block.
ITEM_BYTES = 32
SHARES = 64
TOKEN = re.compile(r"\w+")
HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("matched", T.LongType()),
            T.StructField("tokens", T.LongType()),
        ]
    )
)
BASE, MODULUS = 1_000_003, (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def _rolled(values: list[int], marked: list[bool], length: int) -> dict[int, list[int]]:
    """Starts of the unmarked runs of ``length`` by their Karp-Rabin hash."""
    found, lead = defaultdict(list), pow(BASE, length, MODULUS)
    code = clear = 0
    for at, value in enumerate(values):
        if marked[at]:
            code = clear = 0
            continue
        code, clear = (code * BASE + value) % MODULUS, clear + 1
        if clear > length:
            code = (code - values[at - length] * lead) % MODULUS
        if clear >= length:
            found[code].append(at - length + 1)
    return found


def _before(values: list[int], marked: list[bool], at: int, none: int) -> int:
    """The token before a place, or ``none`` where a match cannot go on to it."""
    return values[at - 1] if at and not marked[at - 1] else none


def _matches(text: list[int], item: list[int], text_marked: list[bool], item_marked: list[bool], length: int) -> list:
    """(-size, item start, text start) of the maximal unmarked matches of at least ``length``."""
    by_code, found = _rolled(text, text_marked, length), []
    for code, starts in _rolled(item, item_marked, length).items():
        if code not in by_code:
            continue
        # A match that has the same token before it on both sides is part of one that starts earlier.
        groups: dict[int, list[int]] = defaultdict(list)
        for p in starts:
            groups[_before(item, item_marked, p, -1)].append(p)
        for t in by_code[code]:
            own = _before(text, text_marked, t, -2)
            for token, places in groups.items():
                if token == own:
                    continue
                for p in places:
                    size = 0
                    while (
                        t + size < len(text)
                        and p + size < len(item)
                        and text[t + size] == item[p + size]
                        and not text_marked[t + size]
                        and not item_marked[p + size]
                    ):
                        size += 1
                    if size >= length:
                        found.append((-size, p, t))
    return sorted(found)


def tiled(text: list[int], item: list[int], min_match: int) -> int:
    """How many tokens of the item greedy string tiling covers with tiles of at least ``min_match``."""
    text_marked, item_marked = [False] * len(text), [False] * len(item)
    covered, length = 0, max(min_match, min(len(item), len(text)))
    while True:
        # The longest match decides: all tiles of its size go first, so the order is greedy exactly.
        found = _matches(text, item, text_marked, item_marked, length)
        if not found:
            if length <= min_match:
                return covered
            length = max(min_match, length // 2)
            continue
        longest = -found[0][0]
        for size, p, t in found:
            if -size < longest:
                break
            if not any(item_marked[p : p + longest]) and not any(text_marked[t : t + longest]):
                item_marked[p : p + longest] = text_marked[t : t + longest] = [True] * longest
                covered += longest


class Block:
    """A block of items, ready to be compared with documents."""

    def __init__(self, items: list[tuple[int | None, str | None]], min_match: int):
        self.min_match = min_match
        self.codes: dict[str, int] = {}
        self.items: list[tuple[int | None, list[int], int]] = []
        # Items by seed, for each length that seeds have; only short items make other lengths.
        self.seeds: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = [self.codes.setdefault(word, len(self.codes) + 1) for word in tokens(text)]
            if not words:
                continue
            length = min(min_match, len(words))
            for run in {tuple(words[at : at + length]) for at in range(len(words) - length + 1)}:
                self.seeds[length][np.array(run, np.int64).tobytes()].append(len(self.items))
            self.items.append((item_id, words, length))

    def hits(self, text: str | None) -> list[dict]:
        words = np.fromiter((self.codes.get(word, 0) for word in tokens(text)), np.int64)
        found: dict[int, set[int]] = defaultdict(set)
        for length, seeds in self.seeds.items():
            if len(words) < length:
                continue
            # Only runs of words that all occur in some item can be seeds.
            known = np.concatenate([[0], np.cumsum(words > 0)])
            for at in np.flatnonzero(known[length:] - known[:-length] == length).tolist():
                for number in seeds.get(words[at : at + length].tobytes(), ()):
                    found[number].update(range(at, at + length))
        result = []
        for number, places in sorted(found.items()):
            item_id, item, length = self.items[number]
            matched = tiled(self._runs(words, sorted(places)), item, length)
            result.append({"item_id": item_id, "matched": matched, "tokens": len(item)})
        return result

    @staticmethod
    def _runs(words: np.ndarray, places: list[int]) -> list[int]:
        """The words at ``places``, with a word that no item has wherever places are skipped.

        Every tile consists of seeds, so tiling these runs gives what tiling the whole text gives.
        """
        runs: list[int] = []
        for i, place in enumerate(places):
            if i and place != places[i - 1] + 1:
                runs.append(0)
            runs.append(int(words[place]))
        return runs


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    """(item_id, text, place) in blocks of bounded size.

    Items are dealt by their place in the table, so that equal ones part too, into many small shares; whole shares
    make up a block.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stage(items.withColumn("place", F.monotonically_increasing_id()), "decontam-items")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ITEM_BYTES)
    total = items.agg(size).first()[0] or 0
    shares = SHARES * max(1, math.ceil(total / BLOCK_BYTES))
    share = F.pmod(F.xxhash64("place"), F.lit(shares))
    sums = {row["share"]: row["size"] for row in items.groupBy(share.alias("share")).agg(size.alias("size")).collect()}
    blocks, held = [[]], 0
    for number, bytes_ in sorted(sums.items()):
        if blocks[-1] and held + bytes_ > BLOCK_BYTES:
            blocks.append([])
            held = 0
        blocks[-1].append(number)
        held += bytes_
    return [items.where(share.between(own[0], own[-1])) if own else items for own in blocks]


def _items(block: DataFrame) -> list[tuple]:
    """The items of a block, in an order of their own. Bounded: see ``_blocks``."""
    rows = [(row["item_id"], row["text"]) for row in block.select("item_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def with_hits(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, text: str = "text", hits: str = "hits") -> DataFrame:
    """``docs`` and the items that share a seed with each text, with the tokens that tiles cover."""
    blocks = _blocks(benchmark)
    if len(blocks) == 1:
        return _compared(docs, _items(blocks[0]), min_match, text, hits)
    # Hits depend on the text alone, so that a hash of it names the row they belong to.
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text <> ''")
    found = None
    for number, block in enumerate(blocks):
        own = _compared(texts, _items(block), min_match, "text", "hits").where("size(hits) > 0")
        own = own.select(_text_key("text"), F.lit(number).alias("block"), "hits").dropDuplicates(["text_key"])
        own = stage(own, "decontam-hits")
        found = own if found is None else found.unionByName(own)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block", "hits"))), lambda part: part["hits"])
    found = stage(found.groupBy("text_key").agg(F.flatten(ordered).alias("found")), "decontam-found")
    size = found.agg(F.sum(F.size("found") * 24 + 64)).first()[0] or 0
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c != hits]
    rows = docs.select(packed(docs), _text_key(text))
    joined = rows.join(F.broadcast(found) if size <= BLOCK_BYTES else found, "text_key", "left")
    return joined.select(*kept, F.coalesce("found", F.array().cast(HITS)).alias(hits))


def _text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))).alias("text_key")


def _compared(docs: DataFrame, items: list[tuple], min_match: int, text: str, hits: str) -> DataFrame:
    """``docs`` and each text's hits among ``items``."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    key = hash(tuple(items)), min_match

    def make(block: Block, texts: list) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("matched", pa.int64()), ("tokens", pa.int64())]))
        return pa.array([block.hits(value) for value in texts], kind)

    return with_column(
        docs, hits, HITS, text, lambda: once_per_worker("decontam", key, lambda: Block(shared.value, min_match)), make
    )


def _covered(hits: str, threshold: float):
    """Hits whose coverage reaches the threshold."""
    return F.filter(hits, lambda hit: hit["matched"] >= hit["tokens"] * threshold)


def judge_documents(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """One row per document: best coverage of an item, the items it holds, and the verdict."""
    found = with_hits(docs.select("doc_id", plain(F.col("text")).alias("text")), benchmark, min_match)
    share = F.transform("hits", lambda hit: hit["matched"] / hit["tokens"])
    held = F.col("held")
    return found.withColumn("held", _covered("hits", threshold)).select(
        "doc_id",
        F.size("hits").cast("long").alias("n_candidates"),
        F.coalesce(F.round(F.array_max(share), 9), F.lit(0.0)).alias("coverage"),
        F.transform(held, lambda hit: hit["item_id"]).alias("item_ids"),
        (F.size(held) > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """The documents that hold no item, all their columns unchanged."""
    name = "_hits"
    while any(c.startswith(name) for c in docs.columns):
        name = "_" + name
    found = with_hits(docs, benchmark, min_match, hits=name)
    return found.where(F.size(_covered(name, threshold)) == 0).drop(name)
