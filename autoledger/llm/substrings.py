"""Substring deduplication by content-defined chunking.

A gear hash rolls over the words of a text, ``h = 2 h + gear(word)``, each word leaving it after a few more. A chunk ends after a word whose hash is the largest among its neighbours, so boundaries depend on the words
around them only: an insertion moves the chunks next to it and no others, and no chunk is shorter than a few words.

Chunks are deduplicated by a 128-bit digest of their words. Chunks are dealt by digest once, and each meets the least document
id of its digest there. Hot digests, which hold at least two partitions' share of all chunks, are found by a bounded sketch
first; their least ids come from sums that combine before the shuffle, are at most half as many as partitions, and are
broadcast, so a chunk in a third of all documents stays where it is. Chunks of
other documents are duplicates; consecutive ones join into spans, and spans of ``MIN_WORDS`` words or more
are reported and cut. A passage of 51 words shared by two texts holds whole chunks for all but the few words
at its ends, which depend on what is around it.

Cases: a null, empty or short text has no span; the first document of a passage keeps it, the others lose it;
repeats within one document are not touched; documents with equal ids count as one document, a null id as the
least; texts under one id are told apart by a hash and have spans of their own, and a row that is repeated has the
spans of one; other columns are not read by ``repeated_spans`` and are kept by ``without_repeats``.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import hot_key_lanes
from .common import by_slice, column, mapped, schema_of, stored, texts_of

# A boundary has the largest hash of this many words on either side.
REACH = 3
# Words that a hash depends on.
ROLL = 4
MIN_WORDS = 16
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MOST_WORDS = 100_000


@lru_cache(maxsize=MOST_WORDS)
def gear(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def boundaries(gears: np.ndarray) -> np.ndarray:
    """Number of words before each cut, of a text's words given by their gear values.

    The sum of shifted gears stops after ``ROLL`` words, and is mixed so that which is largest is arbitrary. Of
    equal neighbours, as in a run of one word, the first is the larger.
    """
    n = len(gears)
    if n <= 2 * REACH + 1:
        return np.array([n], dtype=np.int64)
    rolled = gears.copy()
    for back in range(1, ROLL):
        rolled[back:] += gears[:-back] << np.uint64(back)
    rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    best = np.ones(n, dtype=bool)
    for step in range(1, REACH + 1):
        best[step:] &= rolled[step:] > rolled[:-step]
        best[:-step] &= rolled[:-step] >= rolled[step:]
    cuts = np.flatnonzero(best) + 1
    return cuts if len(cuts) and cuts[-1] == n else np.append(cuts, n)


def chunks_of(text: str) -> list[tuple[int, int, int, bytes]]:
    """Start and end in characters, number of words, and digest of each chunk."""
    words = [match.span() for match in WORD.finditer(text)]
    if not words:
        return []
    spelled = [text[start:end] for start, end in words]
    cuts = boundaries(np.fromiter(map(gear, spelled), dtype=np.uint64, count=len(words)))
    chunks, begin = [], 0
    for cut in cuts.tolist():
        digest = xxhash.xxh3_128_digest(" ".join(spelled[begin:cut]))
        chunks.append((words[begin][0], words[cut - 1][1], cut - begin, digest))
        begin = cut
    return chunks


def hash_of(text: Column) -> Column:
    """Tells the texts under one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def chunks(docs: DataFrame) -> DataFrame:
    """A row per chunk of ``doc_id`` and ``text``, numbered within its text."""

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        names = ["chunk", "start", "end", "words", "digest"]
        found = [chunks_of(text) for text in frame["text"]]
        rows = [(number, *chunk) for one in found for number, chunk in enumerate(one)]
        result = pd.DataFrame(rows, columns=names)
        of = frame[["doc_id", "text_hash"]]
        of = of.loc[of.index.repeat([len(one) for one in found])].reset_index(drop=True)
        return result.assign(doc_id=of["doc_id"], text_hash=of["text_hash"])

    fields = "text_hash long, chunk int, start int, end int, words int, digest binary"
    return mapped(docs.withColumn("text_hash", hash_of(F.col("text"))), by_slice(cut), schema_of(docs, fields))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of text that an earlier document holds as well: ``doc_id``, ``start`` and ``end`` in characters,
    ``words``, and ``first_docs``, the documents that keep them."""
    return spans_by_text(docs, min_words, id, text).drop("text_hash")


def spans_by_text(docs: DataFrame, min_words: int, id: str, text: str) -> DataFrame:
    """``repeated_spans`` with ``text_hash``, as texts of one id have spans of their own."""
    cut = stored(chunks(texts_of(docs, id, text)), "chunks")
    # Some null is 1 and more where a null id is among them, which is before all others.
    facts = {
        "first_doc": F.min("doc_id"),
        "last_doc": F.max("doc_id"),
        "some_null": F.max(F.col("doc_id").isNull()),
    }
    lanes = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = [one for found in hot_key_lanes(cut, [F.col("digest")], lanes).values() for one in found]
    dealt = Window.partitionBy("digest")
    if hot:
        is_hot = F.xxhash64("digest").isin(hot)
        sums = cut.filter(is_hot).groupBy("digest").agg(*[fact.alias(name) for name, fact in facts.items()])
        hot_again = cut.filter(is_hot).join(F.broadcast(sums), "digest")
        cut = cut.filter(~is_hot)
    again = cut.select("*", *[fact.over(dealt).alias(name) for name, fact in facts.items()])
    if hot:
        again = again.unionByName(hot_again)
    shared = (F.col("first_doc") != F.col("last_doc")) | (F.col("some_null") & F.col("first_doc").isNotNull())
    first_doc = F.when(~F.col("some_null"), F.col("first_doc"))
    again = (
        again.filter(shared)
        .withColumn("first_doc", first_doc)
        .filter(F.col("doc_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    )
    # Consecutive chunks keep the difference of their number and their rank. One text's chunks at a time; those of
    # repeated rows have one rank, and only the first of them adds its words.
    by_text = Window.partitionBy("doc_id", "text_hash").orderBy("chunk")
    runs = again.select(
        "*",
        (F.col("chunk") - F.dense_rank().over(by_text)).alias("run"),
        F.lag("chunk").over(by_text).eqNullSafe(F.col("chunk")).alias("is_copy"),
    )
    return (
        runs.groupBy("doc_id", "text_hash", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum(F.when(~F.col("is_copy"), F.col("words"))).alias("words"),
            F.array_sort(F.collect_set("first_doc")).alias("first_docs"),
        )
        .filter(F.col("words") >= min_words)
        .drop("run")
    )


def without_repeats(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id: str = "doc_id",
    text: str = "text",
    n_chars: str = "n_chars",
) -> DataFrame:
    """The documents, with all their columns, their repeated spans cut out of the text; ``n_chars`` follows."""
    spans = spans_by_text(docs, min_words, id, text)
    by_document = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans")
    )
    row = F.struct(*[column(name) for name in docs.columns]).alias("row")
    rows = docs.select(row, column(id).alias("_doc"), column(text).cast("string").alias("_text"))
    same = (F.col("_doc") == F.col("_id")) & (hash_of(F.col("_text")) == F.col("_hash"))
    found = rows.join(by_document, same, "left")
    # What is left stands between the end of one span and the start of the next.
    ends = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda span: span["end"]))
    starts = F.concat(F.transform("_spans", lambda span: span["start"]), F.array(F.char_length("_text")))
    left = F.zip_with(ends, starts, lambda end, start: F.substring(F.col("_text"), end + 1, start - end))
    cut = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(F.array_join(left, ""))
    found = found.withColumn("_cut", cut)
    changed = F.col("_spans").isNotNull()
    values = {text: F.col("_cut"), n_chars: F.char_length("_cut")}
    return found.select(
        *[
            (
                F.when(changed, values[name].cast(kind)).otherwise(F.col("row")[name])
                if name in values
                else F.col("row")[name]
            ).alias(name)
            for name, kind in docs.dtypes
        ]
    )
