"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import covertree, hmm, linededup, mixing, mpeg_audio, neardup, packing, periodic, quality, quality_rules, resample, token_counts, toxicity
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.link(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_audio.digest(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _with_planted_run(words: list[str], doc_id: str) -> list[str]:
    """Of every tenth document by crc32, the words from a place on repeat a period, as the contract of op12 says."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    a, k = h // 10 % n, 3 + h // 10 % 8
    p = 1 + (n - a) // k
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(table(spark, sf_dir, "documents"), rewrite=_with_planted_run)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mixing, op2_ordinal_quality, op3_cover_tree, op4_toxicity, op5_mpeg_audio, op6_token_counts, op7_hmm, op8_line_dedup, op9_packing, op10_minhash, op11_quality_rules, op12_periodic_runs, op13_importance_resampling)}
ORACLE_SQL: dict[str, str] = {"op1_mixing": mixing.ORACLE, "op11_quality_rules": quality_rules.ORACLE, "op13_importance_resampling": resample.ORACLE}
