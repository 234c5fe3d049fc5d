"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

Counts of all n-grams up to an order are a table partitioned by the hash of the n-gram. The corpus has about as many
long n-grams as words, so neither side of the join goes as one row per occurrence:

1. documents are put into blocks of bounded size, written once;
2. a block sends each of its distinct n-grams once, with its number there, to the partition of its hash: one row
   for all n-grams of the block in that partition, a sorted array;
3. a partition adds up the counts and answers each row with the totals, in its order;
4. a block joins the totals to its n-grams, place by place, and sums the scores of its documents.

An n-gram that a third of all documents hold is one entry per block, so no partition is uneven. The number of
partitions follows the number of n-grams, and so does what is moved.

The score of a word after others is ``count(others and word) / count(others)`` if the n-gram occurs ``min_count`` times
or more in the corpus, else ``BACKOFF`` times its score after one word less, down to ``count(word) / total``, which holds
for any count. The others are the ``order - 1`` words before it, or as many as the text has; the first word of a text is
scored alone. A word is backed off if its longest n-gram is not the one that scored it. N-grams are told apart by
64-bit hashes. ``MIN_COUNT`` is two as the texts that are scored are the corpus: an n-gram that occurs once is known
from the place that is scored, and with one counted no word would ever be backed off.

Cases: a null or empty text has no tokens and a null score; repeated rows count as often as they are there and are
answered one by one; null ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_wanted, mapped, schema_of, slices, spelled_ids, spelled_schema, stored, texts_of

ORDER = 2
BACKOFF = 0.4
MIN_COUNT = 2
BLOCK_CHARS = 16_000_000
BUCKET_NGRAMS = 1_000_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
MOST_WORDS = 100_000


@lru_cache(maxsize=MOST_WORDS)
def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def hashed_words(text: str) -> np.ndarray:
    words = WORD.findall(text.translate(LOWER))
    return np.fromiter(map(word_hash, words), dtype=np.uint64, count=len(words))


def longer_hashes(ngrams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One per n-gram and the word that follows it; mixed so that the order of the two matters."""
    mixed = ngrams * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) + words
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def ngrams(texts: list[str], order: int) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """Hashes of the n-grams of all texts end to end, an array for each order from 1, and the number of words of each
    text."""
    words = [hashed_words(text) for text in texts]
    sizes = np.array([len(one) for one in words], dtype=np.int64)
    joined = np.concatenate([np.zeros(0, dtype=np.uint64), *words])

    def by_order() -> Iterator[np.ndarray]:
        places = places_of(sizes)
        hashes, starts = joined, np.arange(len(joined))
        yield hashes
        for n in range(2, order + 1):
            # An n-gram starts where one shorter by a word does and its last word is in the same text.
            fits = sizes.repeat(sizes)[starts] - places[starts] >= n
            starts = starts[fits]
            hashes = longer_hashes(hashes[fits], joined[starts + n - 1])
            yield hashes

    return by_order(), sizes


def places_of(sizes: np.ndarray) -> np.ndarray:
    """The place of each word in its text, from 0."""
    return np.arange(sizes.sum()) - (np.cumsum(sizes) - sizes).repeat(sizes)


def log_scores(totals: Iterator[np.ndarray], sizes: np.ndarray, n_words: int, min_count: int) -> tuple:
    """Log score of each word, and whether it is backed off, by the counts of its n-grams, an array for each order."""
    places = places_of(sizes)
    shorter = next(totals)
    result = np.log(shorter / n_words)
    backed_off = np.zeros(len(shorter), dtype=bool)
    ends = np.arange(len(shorter))
    for order, counts in enumerate(totals, 2):
        # Shorter n-grams by the place of their last word; those that a longer one can end with or start with.
        of_place = np.zeros(len(places))
        of_place[ends] = shorter
        ends = np.flatnonzero(places >= order - 1)
        known = counts >= min_count
        result[ends] = np.where(known, np.log(counts / of_place[ends - 1]), math.log(BACKOFF) + result[ends])
        backed_off[ends] = ~known
        shorter = counts
    return result, backed_off


def unpacked(texts: bytes, sizes: np.ndarray) -> list[str]:
    data, ends = zlib.decompress(texts), np.cumsum(sizes)
    return [data[end - size : end].decode() for end, size in zip(ends.tolist(), sizes)]


def blocks(docs: DataFrame) -> DataFrame:
    """Documents in blocks: ids, and texts end to end, compressed, with their sizes in bytes."""
    id_type = docs.schema["doc_id"].dataType

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 32
        held: list[pd.DataFrame] = []
        chars, number = 0, 0

        def closed() -> pd.DataFrame:
            whole = pd.concat(held)
            data = [text.encode() for text in whole["text"]]
            ids = [None if pd.isna(one) else one for one in whole["doc_id"].astype(object)]
            row = {"block": first + number, "doc_ids": [ids], "sizes": [[len(one) for one in data]]}
            n_words = sum(len(WORD.findall(text)) for text in whole["text"])
            return pd.DataFrame(row | {"texts": [zlib.compress(b"".join(data), 1)], "n_words": n_words})

        for part in slices(frames, "text", BLOCK_CHARS // 4):
            held.append(part)
            chars += int(part["text"].str.len().sum())
            if chars >= BLOCK_CHARS:
                yield closed()
                held, chars, number = [], 0, number + 1
        if held:
            yield closed()

    schema = T.StructType.fromDDL("block long, texts binary, sizes array<int>, n_words long")
    schema = T.StructType([schema["block"], T.StructField("doc_ids", T.ArrayType(id_type)), *schema.fields[1:]])
    return mapped(docs, gather, schema)


def scores(
    docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER, min_count: int = MIN_COUNT
) -> DataFrame:
    """Per document: ``n_tokens``, ``n_backed_off`` words and ``mean_log_score``, by n-grams of up to ``order`` words."""
    if order < 1 or min_count < 1:
        raise ValueError("order and min_count are 1 or more")
    docs = texts_of(docs, id, text)
    held = stored(blocks(docs), "blocks")
    n_words = held.agg(F.sum("n_words")).first()[0] or 0
    bits = max(4, int(n_words // BUCKET_NGRAMS).bit_length())

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                for n, hashes in enumerate(ngrams(unpacked(row.texts, row.sizes), order)[0], 1):
                    distinct, counts = np.unique(hashes, return_counts=True)
                    bucket = (distinct >> np.uint64(64 - bits)).astype(np.int64)
                    cuts = np.flatnonzero(np.diff(bucket)) + 1
                    parts = zip(np.split(bucket, cuts), np.split(distinct, cuts), np.split(counts, cuts))
                    yield pd.DataFrame(
                        [
                            (n, int(of[0]), row.block, part.tobytes(), count.astype("<u4").tobytes())
                            for of, part, count in parts
                            if len(part)
                        ],
                        columns=["order", "bucket", "block", "hashes", "counts"],
                    )

    asked = mapped(
        held.select("block", "texts", "sizes"),
        ask,
        T.StructType.fromDDL("order int, bucket int, block long, hashes binary, counts binary"),
    )

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        """Totals for each row of one partition of the count table."""
        hashes = [np.frombuffer(one, dtype="<u8") for one in frame["hashes"]]
        counts = np.concatenate([np.frombuffer(one, dtype="<u4") for one in frame["counts"]])
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype("<u8")
        ends = np.cumsum([len(one) for one in hashes])
        each = np.split(totals[place], ends[:-1])
        # Four bytes do for a total, but for n-grams so frequent that eight are needed.
        wide = [one.max(initial=0) >= 1 << 32 for one in each]
        return frame[["order", "bucket", "block"]].assign(
            width=[8 if is_wide else 4 for is_wide in wide],
            totals=[one.astype("<u8" if is_wide else "<u4").tobytes() for one, is_wide in zip(each, wide)],
        )

    answered = asked.groupBy("order", "bucket").applyInPandas(
        answer, "order int, bucket int, block long, width int, totals binary"
    )
    words = held.select("block", "doc_ids", "texts", "sizes")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Scores of the documents of one block."""
        results = []
        for row in right.itertuples():
            hashes, sizes = ngrams(unpacked(row.texts, row.sizes), order)

            def totals() -> Iterator[np.ndarray]:
                for n, one in enumerate(hashes, 1):
                    parts = left[left["order"] == n].sort_values("bucket")
                    known = [
                        np.frombuffer(part, dtype=f"<u{width}").astype(np.float64)
                        for part, width in zip(parts["totals"], parts["width"])
                    ]
                    _, place = np.unique(one, return_inverse=True)
                    yield np.concatenate([np.zeros(0), *known])[place]

            result, backed_off = log_scores(totals(), sizes, n_words, min_count)
            of = np.repeat(np.arange(len(sizes)), sizes)
            sums = np.bincount(of, weights=result, minlength=len(sizes))
            means = [total / size if size else None for total, size in zip(sums, sizes)]
            results.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.Series(list(row.doc_ids), dtype=object),
                        "n_tokens": sizes,
                        "n_backed_off": np.bincount(of, weights=backed_off, minlength=len(sizes)).astype(int),
                        "mean_log_score": pd.Series(means, dtype="float64"),
                    }
                )
            )
        return pd.concat(results) if results else pd.DataFrame(columns=fields.names)

    fields = schema_of(docs, "n_tokens long, n_backed_off long, mean_log_score double")
    by_block = answered.groupBy("block").cogroup(spelled_ids(words).groupBy("block"))
    return as_wanted(by_block.applyInPandas(score, spelled_schema(fields)), fields)


# The same in DuckDB.
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
word AS (
  SELECT r, i, w[i] AS x, CASE WHEN i > 1 THEN w[i - 1] END AS h
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
total AS (SELECT count(*) AS n FROM word),
single AS (SELECT x, count(*) AS n FROM word GROUP BY x),
pair AS (SELECT h, x, count(*) AS n FROM word WHERE h IS NOT NULL GROUP BY h, x HAVING count(*) >= {MIN_COUNT}),
scored AS (
  SELECT r, word.h IS NOT NULL AND pair.n IS NULL AS backed_off,
    CASE WHEN word.h IS NULL THEN ln(one.n / total.n)
      WHEN pair.n IS NOT NULL THEN ln(pair.n / before.n) ELSE ln({BACKOFF} * one.n / total.n) END AS score
  FROM word CROSS JOIN total JOIN single one ON one.x = word.x LEFT JOIN single before ON before.x = word.h
    LEFT JOIN pair ON pair.h = word.h AND pair.x = word.x)
SELECT doc_id, CAST(count(score) AS BIGINT) AS n_tokens,
  CAST(coalesce(sum(CAST(backed_off AS INT)), 0) AS BIGINT) AS n_backed_off,
  round(sum(score) / count(score), 6) AS mean_log_score
FROM d LEFT JOIN scored USING (r) GROUP BY d.r, doc_id
"""


def sql(order: int, min_count: int = MIN_COUNT) -> str:
    """The same in DuckDB for any order, n-grams being lists of words."""
    orders = range(2, order + 1)
    counted = "".join(
        f""",
gram{n} AS (
  SELECT w[i - {n - 1} : i] AS g, count(*) AS n FROM word WHERE i >= {n} GROUP BY 1)"""
        for n in orders
    )
    joins = "".join(
        f"""
    LEFT JOIN gram{n} ON i >= {n} AND gram{n}.g = w[i - {n - 1} : i]
    LEFT JOIN gram{n - 1} before{n} ON i >= {n} AND before{n}.g = w[i - {n - 1} : i - 1]"""
        for n in orders
    )
    score, backed_off = "ln(gram1.n / total.n)", "FALSE"
    for n in orders:
        known = f"gram{n}.n >= {min_count}"
        score = f"CASE WHEN i < {n} THEN {score} WHEN {known} THEN ln(gram{n}.n / before{n}.n) ELSE ln({BACKOFF}) + {score} END"
        backed_off = f"CASE WHEN i >= {n} THEN NOT {known} ELSE {backed_off} END"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
word AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
total AS (SELECT count(*) AS n FROM word),
gram1 AS (SELECT w[i : i] AS g, count(*) AS n FROM word GROUP BY 1){counted},
scored AS (
  SELECT r, {backed_off} AS backed_off, {score} AS score
  FROM word CROSS JOIN total JOIN gram1 ON gram1.g = w[i : i]{joins})
SELECT doc_id, CAST(count(score) AS BIGINT) AS n_tokens,
  CAST(coalesce(sum(CAST(backed_off AS INT)), 0) AS BIGINT) AS n_backed_off,
  round(sum(score) / count(score), 6) AS mean_log_score
FROM d LEFT JOIN scored USING (r) GROUP BY d.r, doc_id
"""
