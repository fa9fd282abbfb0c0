"""A training corpus from raw documents, in five stages.

Quality rules reject documents; repeated lines go; of each group of near-duplicates one document stays;
documents that hold benchmark items go; what is left is encoded. Every stage takes and returns the
columns of ``documents`` (the last one adds its results instead of the text) and works on all rows
the stage before it kept.

Null and empty texts fail the quality rules. Null ids and other null columns, very long texts and repeated rows
are documents like any other. Of near documents, equal ones among them, the one with the smallest doc_id stays, a
null id being the last; of repeated rows any one. An empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline.llm import bpe, decontam, linededup, neardup, quality
from ebbline.session import delete, shared_folder, staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on texts and on hosts; a host is the document's source."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more hold, except in the last one to hold them.

    ``n_chars`` is counted again. Documents that lose all their lines stay, with an empty text.
    """
    rewritten = linededup.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return rewritten.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    return neardup.keep_one(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half of a benchmark item or more."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text as packed 32-bit integers, and digests of them and of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte BPE", byte_bpe),
]

# The last stage encodes by a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next.

    Tables that a stage staged on its way, and what it read, are deleted when it has been written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, function) in enumerate(STAGES):
        path = f"{folder}/{number}"
        with staging(spark):
            function(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
