"""Corpus pipeline: quality rules, near-dedup, decontamination, personal data, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the docs of the
next stage. All but the last return the columns of ``documents``; each stage works
on all that its predecessor kept.

The result needs tokenizer ids and packing order, which SQL cannot express:
``ORACLE_SQL`` is None and the tests hold the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm import decontaminate, neardup, packing, pii, quality
from tidecast.llm.q_packing import tokenizer_path
from tidecast.llm.tables import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and line-frequency rules, frequent lines taken out."""
    return quality.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five-word shingles, similarity 0.8)."""
    return neardup.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the words that disclose it replaced."""
    return pii.sanitised(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of every document in windows of at most 2048 tokens."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline_{i}")
    return docs
