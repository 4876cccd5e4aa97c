"""Documents to packed training sequences: quality rules, exact dedup, near dedup, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and reread as the next one's
documents. All but the last return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from merkato.llm import exact_dedup, mixing, packing, quality, simhash  # noqa: E402
from merkato.session import new_path, tune  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose histograms are far from their language's, go."""
    tune(spark)
    return quality.good_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest original stays."""
    tune(spark)
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of four-word shingles at most 4 bits apart, the one with the smallest id stays."""
    tune(spark)
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: not at all, once, or twice."""
    tune(spark)
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    tune(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules), ("exact dedup", exact_copies), ("near dedup", near_copies),
    ("source mix", source_mix), ("packing", packed_sequences),
]

#: The fingerprints and the tokenizer are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
