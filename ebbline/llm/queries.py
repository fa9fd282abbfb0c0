"""The operators applied to the whole test tables: one query per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline.llm import bpe, centroids, decontam, linededup, lm, neardup, phrases, quality, sharding, simhash, tokencount, urls, warc


RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
# The worker of this query does nothing else, so that it has room for twice as many pre-tokens.
REMEMBERED = 2 * bpe.REMEMBERED


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=40)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], with_ids=False, remembered=REMEMBERED)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewritten = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rewritten.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(_table(spark, sf_dir, "pages")).drop("url", "payload")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.label_documents(_table(spark, sf_dir, "documents"), size=2, percent=80)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokencount.read_pieces(public_tokenizers.path(PIECES))
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), pieces)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.best_phrases(_table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.label_documents(_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES = [
    op1_sharding,
    op2_byte_bpe,
    op3_line_dedup,
    op4_lm_scoring,
    op5_quality_rules,
    op6_warc,
    op7_decontamination,
    op8_minhash_neardup,
    op9_url_filters,
    op10_token_counts,
    op11_phrase_mining,
    op12_simhash,
    op13_centroids,
]
