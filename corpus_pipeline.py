"""A training corpus from raw documents: five operators in a row.

Each stage takes all that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.llm import op1_mixing, op3_ngram_join, op6_quality, op7_lines, op9_packing, texts
from granary.llm.queries import table, word_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return op6_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds."""
    return op7_lines.lined_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, at a similarity of 0.8 or more."""
    return op3_ngram_join.first_of_each_group(docs, size=5, per_cent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return op1_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    return op9_packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]

# Regression, hashing and tokenizing are beyond SQL; tests hold the rows against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder.

    Rows between stages are written to the folder that all executors share.
    """
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = texts.written(docs)
    return docs
