"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from claimsieve.llm import (
    conversation_repair,
    global_bpe,
    hilbert_search,
    importance_resampling,
    near_duplicates,
    oracles,
    pattern_packing,
    prefix_tokens,
    quality_cnn,
    quality_rules,
    secret_scan,
    token_files,
    toxicity,
    warc_writer,
)
from claimsieve.llm.shared import table
from claimsieve.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 4096


def op1_prob_min_hash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"))


def op3_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.budgets(prefix_tokens.prefix_tables(table(spark, sf_dir, "documents")), TOKEN_LIMIT)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    base = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    return judged.select(*base)


def op5_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_search.nearest(table(spark, sf_dir, "embeddings"))


def op7_global_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_bpe.digests(table(spark, sf_dir, "documents"))


def op8_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_writer.archive_round_trip(table(spark, sf_dir, "pages"), scratch_folder(spark))


def op11_batch_concatenated_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance_resampling.resample(documents, benchmark).drop("n_words")


def op12_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_round_trip(table(spark, sf_dir, "documents"), scratch_folder(spark))


def op13_suffix_shared_dawg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_prob_min_hash_classes": op1_prob_min_hash_classes,
    "op2_pattern_packing": op2_pattern_packing,
    "op3_prefix_token_counts": op3_prefix_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_byte_cnn_quality": op5_byte_cnn_quality,
    "op6_hilbert_neighbours": op6_hilbert_neighbours,
    "op7_global_word_bpe": op7_global_word_bpe,
    "op8_ngram_toxicity": op8_ngram_toxicity,
    "op9_trigram_secret_scan": op9_trigram_secret_scan,
    "op10_warc_round_trip": op10_warc_round_trip,
    "op11_batch_concatenated_resampling": op11_batch_concatenated_resampling,
    "op12_orc_token_files": op12_orc_token_files,
    "op13_suffix_shared_dawg_repair": op13_suffix_shared_dawg_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op4_quality_rules": oracles.quality_rules_sql(),
    "op9_trigram_secret_scan": oracles.secrets_sql(),
    "op10_warc_round_trip": oracles.WARC_SQL,
    "op11_batch_concatenated_resampling": oracles.resampling_sql(),
}
