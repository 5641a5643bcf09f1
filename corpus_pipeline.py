"""From raw documents to packed training sequences, one operator of ``ledgerloom.llm`` a stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.language import known_languages
from ledgerloom.llm.ngram_join import one_of_each_group
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.quality import good_documents
from ledgerloom.session import stage

#: Near duplicates share 80 of 100 of their five-word shingles, or more.
NEAR_WORDS, NEAR_SHARE = 5, 80

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay."""
    return known_languages(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be good stay; the labels are those of the documents that are left."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, that with the smallest doc_id."""
    return one_of_each_group(docs, NEAR_WORDS, NEAR_SHARE)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents that are left, with their places in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL for trained models and tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
