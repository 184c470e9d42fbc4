"""A corpus pipeline: filter, deduplicate documents and passages, redact, and pack.

Each stage works on all rows that the one before it kept, written as Parquet and read again. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import keep
from promolens.llm.jaccard import Rule, representatives
from promolens.llm.packing import best_fit_packing
from promolens.llm.pii import ANY, redact
from promolens.llm.quality import accepted
from promolens.llm.suffix_dedup import without_repeats

#: Near duplicates: shingles of five words, similarity 0.8 or more.
NEAR = Rule(words=5, num=80, den=100)
#: Passages of over 50 words must not repeat, whatever their length in bytes.
PASSAGE = 51


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return representatives(docs, NEAR)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 400 or more and passages of over 50 words that repeat are cut out."""
    return _sized(without_repeats(docs, words=PASSAGE))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it become labels."""
    return _sized(redact(docs, support=ANY))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in packed sequences."""
    return best_fit_packing(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", suffix_array_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The model of the first stage and the tokens of the last one are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
