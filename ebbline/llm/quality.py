"""Quality rules on documents and on their hosts.

Every document is measured on its own, inside its row: words, symbols, repeated lines and words in
repeated runs. A host's share of failing documents is shrunk towards the other hosts' by a beta prior
that the hosts' own shares fit, and the verdict on a host is joined back to its documents. So a host
with three documents is not judged like one with three million.

All measuring is linear or n log n in a text's length and stays in its row. Only counts per host are
shuffled, combined before they move; the join back carries no text, and moves no document while the hosts are few
enough to be broadcast.

Null and empty texts have no words and fail. A null host is a host of its own. Repeated rows count
each time. An empty table gives no rows. Input columns besides the three used are never looked at, or
are passed on unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ebbline.llm.text import SPACE_CHARS, SPACE_CLASS, packed, plain
from ebbline.session import stage

SYMBOLS = "#*$%&|<>"
RUN = 5
# A table of hosts is broadcast up to this size; and what a row takes besides its name.
BROADCAST_BYTES = 32_000_000
HOST_BYTES = 64


@dataclass(frozen=True)
class QualityOptions:
    min_words: int = 10
    max_repeat_percent: int = 20
    # A host goes when its shrunk share of failing documents is above this.
    max_host_rate: float = 0.5
    # Bounds of the prior's weight, in documents, for hosts that differ wildly or not at all.
    min_prior: float = 1.0
    max_prior: float = 1000.0


def _without(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body``, in which ``name`` stands for ``value``, worked out once and never a column of its own."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeats(words_name: str) -> str:
    """SQL for the number of words in repeated runs.

    Repeated runs are found by sorting only where hashes show any. Equal runs have equal hashes, so a text whose
    hashes all differ has none; otherwise the runs' own words are compared.
    """
    run = ", ".join(f"{words_name}[i + {k}]" for k in range(RUN))
    places = f"sequence(0, size({words_name}) - {RUN})"
    ordered = f"array_sort(transform({places}, i -> named_struct('g', concat_ws(' ', {run}), 'i', i)))"
    starts = (
        "array_sort(transform(filter(sequence(0, size(o) - 1),"
        " k -> o[k].g <=> get(o, k - 1).g OR o[k].g <=> get(o, k + 1).g), k -> o[k].i))"
    )
    covered = (
        f"IF(size(s) = 0, 0L, aggregate(sequence(0, size(s) - 1), 0L, (sum, k) -> sum"
        f" + IF(k = 0, {RUN}, least({RUN}, s[k] - get(s, k - 1)))))"
    )
    compared = _let(ordered, "o", _let(starts, "s", covered))
    hashed = _let(f"transform({places}, i -> xxhash64({run}))", "r", f"IF(size(array_distinct(r)) < size(r), {compared}, 0L)")
    return f"IF(size({words_name}) >= {RUN}, {hashed}, 0L)"


def _words(text: str) -> str:
    """SQL for the words of the column ``text``, as ``text.words`` has them."""
    trimmed = f"btrim(coalesce(CAST(`{text}` AS STRING), ''), '{SPACE_CHARS}')"
    return f"IF({trimmed} = '', CAST(array() AS array<string>), split({trimmed}, '[{SPACE_CHARS}]+'))"


def _counts(text: str) -> Column:
    """A struct of n_words and n_repeat_words. Words and runs live in this expression alone, in no row."""
    return F.expr(_let(_words(text), "w", f"named_struct('n_words', CAST(size(w) AS BIGINT), 'n_repeat_words', {_repeats('w')})"))


def _measured(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the measures, from the text as it was read."""
    value = plain(F.col(text))
    lines = F.filter(F.split(value, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    repeated = F.transform(F.array(lines), lambda own: F.size(own) - F.size(F.array_distinct(own)))[0]
    return docs.select(
        *keep,
        _counts(text).alias("_counts"),
        F.char_length(F.regexp_replace(value, SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        _without(value, SYMBOLS).cast("long").alias("n_symbols"),
        repeated.cast("long").alias("n_dup_lines"),
    ).select(*keep, "_counts.n_words", "word_chars", "n_symbols", "n_dup_lines", "_counts.n_repeat_words")


def _failed(options: QualityOptions, of: str = "") -> Column:
    words, repeated = F.col(f"{of}n_words"), F.col(f"{of}n_repeat_words")
    return (words < options.min_words) | (100 * repeated > options.max_repeat_percent * words)


def host_verdicts(measured: DataFrame, options: QualityOptions) -> DataFrame:
    """Per ``host_key``: documents, failing ones, the shrunk share and whether the host is kept.

    The prior has the mean and variance of the hosts' raw shares (method of moments), its weight held
    within the options' bounds. Only those two numbers reach the driver.
    """
    hosts = measured.groupBy("host_key").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")
    )
    rate = F.col("host_failed") / F.col("host_docs")
    mean, variance = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, variance = mean or 0.0, variance or 0.0
    weight = mean * (1 - mean) / variance - 1 if variance > 0 else options.max_prior
    weight = min(max(weight, options.min_prior), options.max_prior)
    shrunk = (F.col("host_failed") + F.lit(mean * weight)) / (F.col("host_docs") + F.lit(weight))
    return hosts.select(
        "host_key",
        "host_docs",
        "host_failed",
        shrunk.alias("host_rate"),
        (shrunk <= options.max_host_rate).alias("host_kept"),
    )


def _listed(hosts: DataFrame) -> DataFrame:
    """A table of hosts, written down, with a broadcast hint if its measured size is small.

    So a host with a third of all documents is joined where its documents are.
    """
    hosts = stage(hosts, "quality-hosts")
    size = hosts.agg(F.sum(F.octet_length("host_key") + HOST_BYTES)).first()[0] or 0
    return F.broadcast(hosts) if size <= BROADCAST_BYTES else hosts


def _host_key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("")).alias("host_key")


def judge_documents(
    docs: DataFrame, options: QualityOptions = QualityOptions(), host: str = "source", text: str = "text"
) -> DataFrame:
    """One row per document: measures, the base verdict, its host's figures and the final verdict."""
    chosen = docs.select("doc_id", _host_key(host), F.col(text).alias("text"))
    measured = stage(
        _measured(chosen, "text", ["doc_id", "host_key"]).withColumn("base_failed", _failed(options)), "quality"
    )
    judged = measured.join(_listed(host_verdicts(measured, options)), "host_key")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"),
        F.round("host_rate", 9).alias("host_rate"),
    )


def keep_good(
    docs: DataFrame, options: QualityOptions = QualityOptions(), host: str = "source", text: str = "text"
) -> DataFrame:
    """The documents that pass, all their columns unchanged.

    Texts are measured once and written with their verdict. What is joined is the list of hosts
    that go, broadcast while it is short, so that texts are not shuffled.
    """
    counted = docs.select(packed(docs), _host_key(host), _counts(text).alias("_counts"))
    judged = stage(counted.select("row", "host_key", _failed(options, "_counts.").alias("base_failed")), "quality-rows")
    gone = host_verdicts(judged, options).where("NOT host_kept").select("host_key")
    return judged.where("NOT base_failed").join(_listed(gone), "host_key", "left_anti").select("row.*")
