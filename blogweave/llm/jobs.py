"""The queries of the operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit_packing, bit_packing, cotraining, cross_polytope, decontamination, importance_resampling, language_id,
               lexical_packing, license_scan, ngram_lm, order_minhash, prefix_trie, warc)
from .store import bounded, table


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    row = F.concat_ws("-", F.hex(F.xxhash64("_metadata.file_path")), "_metadata.row_index")      # a row's place in its file
    return warc.archive_round_trip(pages.select("page_id", "url", "html", row.alias("row")), row=F.col("row"))


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.search_embeddings(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_packing.pack_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.digest(best_fit_packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def _query(f: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(bounded(spark), sf_dir)
    run.__doc__, run.__name__ = f.__doc__, f.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _query(f) for f in (
    op1_order_minhash, op2_license_scan, op3_ngram_lm, op4_warc, op5_cross_polytope, op6_bit_packing, op7_lexical_packing,
    op8_cotraining, op9_decontamination, op10_language_id, op11_importance_resampling, op12_sum_of_squares_packing, op13_prefix_trie)}

SQL: dict[str, str] = {"op2_license_scan": license_scan.scan_sql(), "op4_warc": warc.SQL,
                       "op11_importance_resampling": importance_resampling.resample_sql(), "op13_prefix_trie": prefix_trie.SQL}
