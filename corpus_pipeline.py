"""The corpus pipeline: documents to packed sequences, stage by stage.

Each stage is written to the shared folder and read again as the next one's documents, so a lost executor or a
failed stage costs that stage alone. Where Spark does not merge small partitions, files go by the documents
and not by the session's shuffle partitions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from autoledger.llm import decontamination, near_duplicates, packing, quality_rules, substrings
from autoledger.llm.common import files_for, in_files, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines leave the texts, failing documents go."""
    return quality_rules.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    files = files_for(docs)
    return in_files(near_duplicates.first_of_each(docs, files=files), files)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut."""
    return in_files(substrings.without_repeats(docs), files_for(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    files = files_for(docs)
    return in_files(decontamination.clean_documents(docs, items, files=files), files)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its sequence and its place there."""
    files = files_for(docs)
    return in_files(packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), files=files), files)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]

# Signatures, tokenizers and bin completion are beyond SQL; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
