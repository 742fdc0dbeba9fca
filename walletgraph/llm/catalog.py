"""The operators as registered queries over whole tables, and SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from walletgraph.llm import cover_tree, filter_audit, fm_index, id_files, jaccard, language, licenses, line_dedup, merkle, packing, repeats, tokens
from walletgraph.llm.oracles import ORACLES
from walletgraph.shared import new_path

__all__ = ["ORACLES", "QUERIES"]

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans")


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "ids")
    files, dictionary = id_files.write(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), folder)
    return id_files.read(files, folder, dictionary)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(_table(spark, sf_dir, "documents"), "suffix_array")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(_table(spark, sf_dir, "documents"), "automata")


def op9_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(_table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_license_scans": op3_license_scans,
    "op4_token_counts": op4_token_counts,
    "op5_token_id_output": op5_token_id_output,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_exact_top_k_search": op9_exact_top_k_search,
    "op10_language_id": op10_language_id,
    "op11_filter_interaction_audit": op11_filter_interaction_audit,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_line_dedup": op13_line_dedup,
}
