"""Documents to packed training sequences: five stages, each an operator of shelfmark.llm over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontaminate, language, packing, personal_data, simhash
from shelfmark.llm.text import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known; the others go."""
    return language.in_known_language(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, at most 4 differing bits."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that benchmark items cover by a twentieth; from others the covered words are cut."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the kind's name in place of personal data."""
    return personal_data.mask(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2,048 tokens, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_masking", pii_masking),
    ("sequence_packing", sequence_packing),
]

# Fingerprints, tokens and trained models are beyond SQL; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
