"""From raw documents to packed sequences: the stages, each over all that the
stage before it kept.

``STAGES`` are called as (spark, docs, sf_dir); ``run`` writes each stage's
result as Parquet to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blogweave.llm import cotraining, decontamination, language_id, lexical_packing, order_minhash
from blogweave.llm.store import bounded, kept, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good ones."""
    return cotraining.keep_good(docs, table(bounded(spark), sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found."""
    bounded(spark)
    return language_id.keep_identified(docs)


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    bounded(spark)
    return order_minhash.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a question of the benchmark."""
    return decontamination.keep_clean(docs, table(bounded(spark), sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    bounded(spark)
    return lexical_packing.pack_documents(docs)


STAGES = [("quality", quality), ("language", language), ("deduplication", deduplication), ("decontamination", decontaminated),
          ("packing", packing)]

#: The classifiers and the packing are not SQL; tests/llm holds the pipeline against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(bounded(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
