"""The queries opN_<name> over the tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import bpe, fim, fingerprints, jaccard, kneser_ney, language, lines, packing, quality, quotes, resampling, substrings, toxicity
from tollgate.llm.tables import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_held_out(documents(spark, sf_dir))


def op2_fingerprint_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(documents(spark, sf_dir))


def op3_deletion_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(documents(spark, sf_dir))


def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_vertical_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir), 4, 85)


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


def op8_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(documents(spark, sf_dir))


def op10_ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_trie_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_automaton_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(documents(spark, sf_dir))


def op13_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_kneser_ney, op2_fingerprint_runs, op3_deletion_neighbourhood, op4_ftrl_toxicity, op5_vertical_jaccard, op6_quotation_linking, op7_best_fit_packing, op8_bpe_segment_tree, op9_scaled_sketch, op10_ngram_perplexity, op11_trie_resampling, op12_automaton_fim, op13_output_codes)}
ORACLES: dict[str, str] = {"op6_quotation_linking": quotes.ORACLE, "op12_automaton_fim": fim.ORACLE}
