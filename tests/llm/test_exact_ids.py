"""Ids beyond 2^53 and null ids in one batch stay what they are, in every operator that calls Python."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from autoledger.llm import backoff, licenses, near_duplicates, packing, queries, revisits, substrings, token_counts, wavelet

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LARGE = 1 << 60
IDS = [None, LARGE + 1, LARGE + 3, -LARGE - 1]


@pytest.fixture
def large(spark):
    texts = [" ".join(f"word{n}x{i}" for i in range(80)) for n in range(len(IDS))]
    rows = [(one, text, "en", "s", len(text)) for one, text in zip(IDS, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


@pytest.mark.parametrize(
    "operator",
    [
        lambda docs: token_counts.token_counts(docs, BYTES),
        lambda docs: packing.packed(docs, WORDS),
        lambda docs: backoff.scores(docs),
        lambda docs: wavelet.read_back(wavelet.written(docs, WORDS)),
        lambda docs: near_duplicates.classes(docs),
        lambda docs: near_duplicates.first_of_each(docs),
        lambda docs: substrings.without_repeats(docs),
    ],
)
def test_ids_are_exact(large, operator):
    found = operator(large)
    assert dict(found.dtypes)["doc_id"] == "bigint"
    assert {row.doc_id for row in found.collect()} == set(IDS)


def test_classes_of_exact_ids(large):
    rows = near_duplicates.classes(large).collect()
    assert {(row.doc_id, row.class_id) for row in rows} == {(one, one) for one in IDS}


def test_spans_of_exact_ids(spark):
    passage = " ".join(f"shared{i}" for i in range(80))
    rows = [(None, "other words only"), (LARGE + 1, passage), (LARGE + 3, f"before it {passage} after it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    (span,) = substrings.repeated_spans(docs).collect()
    assert span.doc_id == LARGE + 3 and span.first_docs == [LARGE + 1]


def test_licenses_of_files_without_id(spark, tmp_path, large):
    large.write.parquet(f"{tmp_path}/documents.parquet")
    assert {row.doc_id for row in queries.op2_license_scan(spark, str(tmp_path)).collect()} == set(IDS)
    names = {row.path.split("/")[-1] for row in licenses.files_of_documents(large).collect()}
    assert "none.txt" in names


def test_many_lanes_are_one_expression(spark):
    times = spark.range(2000).select(F.col("id"), (F.col("id") * 7 % 1000).alias("time"))
    bounds = list(range(0, 1000, 3))
    rows = times.select("time", revisits.lane_of(F.col("time"), bounds).alias("lane")).collect()
    assert all(row.lane == sum(bound <= row.time for bound in bounds) for row in rows)
    captures = times.select(
        F.col("id").alias("record_id"),
        F.lit("http://a.example/x").alias("url"),
        F.col("id").alias("time"),
        F.when(F.col("id") % 2 == 0, "response").otherwise("revisit").alias("kind"),
        F.when(F.col("id") % 2 == 0, 'W/"t"').otherwise('"t"').alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("map<string,string>").alias("headers"),
    )
    found = revisits.resolved_revisits(captures, lanes=1500)
    rows = found.collect()
    assert len(rows) == 1000 and all(row.status == "resolved" for row in rows)
    assert all(row.response_id == row.record_id - 1 for row in rows)
