"""Plain Python versions of the text operators, written from their definitions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def jump(key, shards):
    key, last, following = (key or 0) % 2**64, -1, 0
    while following < shards:
        last = following
        key = (key * 2862933555777941757 + 1) % 2**64
        following = int((last + 1) * (2.0**31 / ((key >> 33) + 1)))
    return last


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text, w = text or "", words(text)
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if words(line)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def host_rates(rows):
    """Shrunk failure rates by host, of (host, failed) rows."""
    counts = defaultdict(lambda: [0, 0])
    for host, failed in rows:
        counts[host][0] += 1
        counts[host][1] += failed
    rates = [k / n for n, k in counts.values()]
    mean = sum(rates) / len(rates) if rates else 0
    variance = sum((r - mean) ** 2 for r in rates) / len(rates) if rates else 0
    weight = mean * (1 - mean) / variance - 1 if variance > 0 else 1000.0
    weight = min(max(weight, 1.0), 1000.0)
    return {host: (k + mean * weight) / (n + weight) for host, (n, k) in counts.items()}


def kept_lines(docs, min_chars=20, min_docs=3):
    """(text left, lines, lines dropped) per (doc_id, text) row."""
    key = lambda line: lower(line.strip(SPACES))
    number = lambda doc_id: (doc_id is not None, doc_id or 0)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(number(doc_id))
    result = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        left = [
            line
            for line in lines
            if len(holders.get(key(line), ())) < min_docs or max(holders[key(line)]) == number(doc_id)
        ]
        result.append(("\n".join(left), len(lines), len(lines) - len(left)))
    return result


def shingles(text, size):
    w = words(lower(text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near_groups(docs, size, percent=80):
    """Per (doc_id, text) row: size of its set and the rows reachable from it."""
    sets = [shingles(text, size) for _, text in docs]
    holders = defaultdict(list)
    for row, own in enumerate(sets):
        for shingle in own:
            holders[shingle].append(row)
    parent = list(range(len(docs)))

    def root(row):
        while parent[row] != row:
            row = parent[row]
        return row

    for row, own in enumerate(sets):
        shared = Counter(other for shingle in own for other in holders[shingle] if other < row)
        for other, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[other]) - both):
                parent[max(root(row), root(other))] = min(root(row), root(other))
    return [(len(own), root(row)) for row, own in enumerate(sets)]


def tiling(text, item, least):
    """Tokens of ``item`` that greedy string tiling covers."""
    text_marked, item_marked, covered = [False] * len(text), [False] * len(item), 0
    while True:
        best, found = least, []
        for p in range(len(item)):
            for t in range(len(text)):
                k = 0
                while (
                    p + k < len(item)
                    and t + k < len(text)
                    and item[p + k] == text[t + k]
                    and not item_marked[p + k]
                    and not text_marked[t + k]
                ):
                    k += 1
                if k > best:
                    best, found = k, [(p, t)]
                elif k == best:
                    found.append((p, t))
        if not found:
            return covered
        for p, t in found:
            if not any(item_marked[p : p + best]) and not any(text_marked[t : t + best]):
                item_marked[p : p + best] = text_marked[t : t + best] = [True] * best
                covered += best


def contaminated(text, items, least=5, threshold=0.5):
    """Ids of the items of (item_id, text) that the text holds."""
    own, held = re.findall(r"\w+", (text or "").lower()), []
    known = {tuple(own[i : i + k]) for k in range(1, least + 1) for i in range(len(own) - k + 1)}
    for item_id, item in items:
        tokens = re.findall(r"\w+", (item or "").lower())
        size = min(least, len(tokens))
        if tokens and any(tuple(tokens[i : i + size]) in known for i in range(len(tokens) - size + 1)):
            if tiling(own, tokens, size) >= threshold * len(tokens):
                held.append(item_id)
    return held


def base_scores(docs, is_held_out):
    """(tokens, known, add-one unigram score) per (doc_id, text) row, and the number learned from."""
    tokens = [[*words(lower(text or "")), None] for _, text in docs]
    counts = Counter(t for (doc_id, _), own in zip(docs, tokens) if not is_held_out(doc_id) for t in own)
    total = sum(counts.values())
    unit = math.log10(total + len(counts) + 1)
    return [
        (len(own), sum(counts[t] > 0 for t in own), sum(math.log10(counts[t] + 1) - unit for t in own)) for own in tokens
    ], total


def simhash(text):
    """64-bit fingerprint of the three-word shingles, repeats included."""
    w = words(lower(text or ""))
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_numbers(numbers, radius):
    """Per number the first of its component under links of at most ``radius`` differing bits."""
    parent = list(range(len(numbers)))

    def root(row):
        while parent[row] != row:
            row = parent[row]
        return row

    for row, number in enumerate(numbers):
        for other in range(row):
            if (number ^ numbers[other]).bit_count() <= radius:
                parent[max(root(row), root(other))] = min(root(row), root(other))
    return [root(row) for row in range(len(numbers))]


def collocations(docs, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    rows = []
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        scored = []
        for phrase, a in candidates.items():
            cuts = [(1000000 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            longer = [f for p, f in candidates.items() if len(p) == 3 > len(phrase) and phrase in (p[:2], p[1:])]
            if not any(100 * f >= 50 * a for f in longer):
                text = " ".join(phrase)
                scored.append((-score, -a, text.encode(), text, found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, _, text, l, r) in enumerate(sorted(scored)[:top], 1):
            rows.append((lang, rank, text, -a, l, r, totals[lang], -score))
    return sorted(rows)


def k_means(vectors, clusters=8, rounds=10, seed="3"):
    """(id, cluster, distance) of (id, whole numbers) rows, and the centroids."""
    digest = lambda i: "~" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(vectors, key=lambda row: (digest(row[0]), row[1]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in vectors:
            members[nearest(v)[1]].append(v)
        for k, own in members.items():
            centroids[k] = [sum(cells) // len(own) for cells in zip(*own)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in vectors], centroids


def gru_log10(weights, symbols, start=0):
    """log10 probability of a document's symbols, one step after another in double precision."""
    w = {name: np.asarray(value, np.float64) for name, value in weights.items()}
    hidden, members = w["recurrent"].shape[0], w["member_bias"].shape[1]
    share = lambda logits, at: logits[at] - np.logaddexp.reduce(logits)
    state, before, total = np.zeros(hidden), start, 0.0
    for symbol in symbols:
        given, own = w["input"][before], state @ w["recurrent"]
        gates = 1 / (1 + np.exp(-(given + own)[: 2 * hidden]))
        fresh = np.tanh(given[2 * hidden :] + gates[hidden:] * own[2 * hidden :])
        state = gates[:hidden] * state + (1 - gates[:hidden]) * fresh
        group, place = divmod(symbol, members)
        total += share(state @ w["class"] + w["class_bias"], group)
        total += share(state @ w["member"][group] + w["member_bias"][group], place)
        before = symbol
    return total / math.log(10)


def model_scores(docs, weights, is_held_out, vocabulary):
    """The model's score per (doc_id, text) row: 0 is the end, 1 all words that are no symbols."""
    counts = Counter(t for doc_id, text in docs if not is_held_out(doc_id) for t in words(lower(text or "")))
    top = sorted(counts, key=lambda t: (-counts[t], t.encode()))[:vocabulary]
    symbol = {t: 2 + i for i, t in enumerate(top)}
    rest = sum(c + 1 for t, c in counts.items() if t not in symbol) + 1
    found = []
    for _, text in docs:
        own = words(lower(text or ""))
        shared = sum(math.log10((counts[t] + 1) / rest) for t in own if t not in symbol)
        found.append(gru_log10(weights, [*[symbol.get(t, 1) for t in own], 0]) + shared)
    return found
