"""Cleaning and mixing a corpus: five stages over ``documents``, each over what the last one kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last return the columns
of ``documents``. ``run`` writes each stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, line_dedup, mixing, quality_rules, simhash_dedup
from tidemark.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line, also with a few edits."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (3-word shingles, 2 bits)."""
    return simhash_dedup.keep_one(docs, shingle=3, max_bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document, so that sources meet their targets."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
]

# Fingerprints, edit joins and the dual of the mixture are beyond SQL; tests/llm compares run()
# with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
