"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    backoff,
    decontamination,
    differencing,
    hard_negatives,
    licenses,
    near_duplicates,
    packing,
    quality_rules,
    revisits,
    substrings,
    token_counts,
    turn_repair,
    wavelet,
)

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 1024
TRIGRAMS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each text, and how much of it fits into the limit."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer)
    prefixes = F.col("prefix_tokens")
    n_tokens = token_counts.tokens_in_all(prefixes)
    return counts.select(
        "doc_id",
        "n_bytes",
        n_tokens.cast("long").alias("n_tokens"),
        (n_tokens > TOKEN_LIMIT).alias("over_limit"),
        token_counts.longest_prefix(prefixes, TOKEN_LIMIT).alias("chars_within_limit"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree, each with its own or its inherited license."""
    files = licenses.files_of_documents(table(spark, sf_dir, "documents"))
    found = licenses.licenses(files)
    number = F.regexp_extract("path", r"/(?:LICENSE-)?(-?[0-9]+)(?:\.txt)?$", 1).try_cast("long")
    return found.select(
        number.alias("doc_id"), "path", "license", "origin", F.round("cosine", 6).alias("cosine"), "licensed_by"
    )


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = revisits.captures_of_pages(table(spark, sf_dir, "pages"))
    found = revisits.resolved_revisits(captures, visit_parameters=revisits.SQL_VISIT_PARAMETERS)
    lines = F.transform("headers", lambda entry: F.concat(entry["key"], F.lit(": "), entry["value"]))
    return found.withColumn("headers", F.array_join(lines, "; "))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer)


def op5_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff.scores(table(spark, sf_dir, "documents"))
    return found.withColumn("mean_log_score", F.round("mean_log_score", 6))


def op5_trigram_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores under counts of up to three words."""
    found = backoff.scores(table(spark, sf_dir, "documents"), order=TRIGRAMS)
    return found.withColumn("mean_log_score", F.round("mean_log_score", 6))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span that an earlier document holds, with the documents that keep it."""
    return substrings.repeated_spans(table(spark, sf_dir, "documents"))


def op7_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return wavelet.read_back(wavelet.written(table(spark, sf_dir, "documents"), tokenizer))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class."""
    return near_duplicates.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are every hundredth vector; every seventh has its neighbour's label."""
    found = hard_negatives.quantised(table(spark, sf_dir, "embeddings"))
    label = F.col("label").cast("long")
    other = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(found.withColumn("label", other), F.col("vec_id") % 100 == 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations with their faults and their cheapest repair."""
    rows = turn_repair.damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.repaired(rows, present=F.col("present"))


def op13_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return differencing.packed(table(spark, sf_dir, "documents"), tokenizer)


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_license_scan": op2_license_scan,
        "op3_warc_revisits": op3_warc_revisits,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_stupid_backoff": op5_stupid_backoff,
        "op5_trigram_backoff": op5_trigram_backoff,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_wavelet_matrix": op7_wavelet_matrix,
        "op8_decontamination": op8_decontamination,
        "op9_minhash_near_dedup": op9_minhash_near_dedup,
        "op10_quality_rules": op10_quality_rules,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_differencing_packing": op13_differencing_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_revisits": revisits.SQL,
        "op5_stupid_backoff": backoff.SQL,
        "op5_trigram_backoff": backoff.sql(TRIGRAMS),
        "op8_decontamination": decontamination.SQL,
        "op10_quality_rules": quality_rules.SQL,
        "op11_hard_negatives": hard_negatives.SQL,
    }
