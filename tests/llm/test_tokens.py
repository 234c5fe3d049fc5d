"""Token counts, packing and wavelet shards against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from autoledger.llm import packing, queries, token_counts, wavelet
from autoledger.llm.token_counts import PrefixCounter
from autoledger.llm.wavelet import WaveletMatrix
from autoledger.llm.word_tokens import WordTokens

from .conftest import SMALL, awkward_rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abé'sStTmMlLrevdD09 ½ªµ\n\t\r.,!|_ß×\xad¡   日　\x85\x1c🙂"


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(BYTES)


def library_counts(text: str) -> list[int]:
    tokenizer = Tokenizer.from_file(BYTES)
    return [len(tokenizer.encode(text[:end], add_special_tokens=False).ids) for end in range(len(text) + 1)]


@pytest.mark.parametrize(
    "text",
    [
        "",
        "a",
        "Hello   world\n\n  it's we'll 'x'",
        "a <|endoftext|> b",
        "x<|endoftext|><|endoftext|>  y  <|end",
        "日本語 🙂🙂  İstanbul",
    ],
)
def test_counts_of_every_prefix(counter, text):
    assert counter.counts(text).tolist() == library_counts(text)


def test_counts_of_random_texts(counter):
    draw = random.Random(1)
    for _ in range(200):
        text = "".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 25)))
        assert counter.counts(text).tolist() == library_counts(text), text


def test_counts_of_one_very_long_word(counter):
    text = "ab" * 30_000
    whole = Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False)
    assert counter.counts(text)[-1] == len(whole.ids)


def test_budget_questions(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, None)], "doc_id long, text string")
    counts = token_counts.token_counts(docs, BYTES)
    prefixes = F.col("prefix_tokens")
    rows = counts.select(
        "doc_id",
        token_counts.tokens_in_all(prefixes).alias("all"),
        token_counts.longest_prefix(prefixes, 2).alias("chars"),
        token_counts.tokens_in_prefix(prefixes, F.lit(7)).alias("seven"),
    )
    assert sorted(map(tuple, rows.collect())) == [(1, 4, 7, 2), (2, 0, 0, 0)]


def test_op1_on_the_table(spark):
    got = {row.doc_id: row for row in queries.op1_token_counts(spark, SMALL).collect()}
    tokenizer = Tokenizer.from_file(BYTES)
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        text = row.text or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        found = got[row.doc_id]
        assert (found.n_bytes, found.n_tokens, found.over_limit) == (len(text.encode()), n, n > 1024)
        if n <= 1024:
            assert found.chars_within_limit == len(text)


def test_word_ids_are_the_librarys():
    encoder, draw = WordTokens(WORDS), random.Random(2)
    texts = ["".join(draw.choice(LETTERS) for _ in range(30)) for _ in range(500)]
    texts += ["", "<|endoftext|> a", "don't WE'LL", "ΑΣ.Β", "x\x1cy"]
    assert encoder.encode(texts) == encoder.library(texts)


EDGE_CASES = [
    "", " ", "\n\n", "'", "'s", " 's", "\n's", "it's 're'd", "x'll've", "a  b", "a\n b", "a \nb", "a ", "12 3", "a" * 8,
    "a" * 9, f"{'a' * 70} {'a' * 71} {'a' * 70}", "ÀÉ ß µ ²½", "<|endoftext|> a", "日本", "x\x00y",
]


def test_batches_split_as_the_library_does():
    draw = random.Random(7)
    texts = [*EDGE_CASES, *("".join(draw.choice("abstvrel'' \n.1À") for _ in range(20)) for _ in range(200))]
    words, counter = WordTokens(WORDS), PrefixCounter(BYTES)
    assert words.encode(texts) == words.library(texts)
    library = Tokenizer.from_file(BYTES)
    for text, counts in zip(texts, counter.all_counts(texts)):
        prefixes = [text[:end] for end in range(len(text) + 1)]
        assert counts.tolist() == [len(library.encode(one, add_special_tokens=False).ids) for one in prefixes]
    assert words.encode([]) == [] and counter.all_counts([]) == []


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr("autoledger.llm.word_tokens.MOST_WORDS", 4)
    monkeypatch.setattr("autoledger.llm.token_counts.MOST_WORDS", 4)
    texts = ["one two three four", "two five six", "one seven", "two one"]
    words, counter = WordTokens(WORDS), PrefixCounter(BYTES)
    for text in texts:
        assert words.encode([text]) == words.library([text])
        assert counter.all_counts([text])[0].tolist() == PrefixCounter(BYTES).counts(text).tolist()


def ids_of(text: str | None, end: int) -> bytes:
    ids = Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4").tobytes()


def checked_packing(rows, texts: Counter) -> int:
    """Number of sequences, after all has been checked."""
    expected = Counter()
    for (doc_id, text), times in texts.items():
        ids = ids_of(text, 0)
        for piece, start in enumerate(range(0, len(ids), 8192)):
            part = ids[start : start + 8192]
            expected[doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)] += times
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    filled = Counter()
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == filled[row.sequence_id]
        filled[row.sequence_id] += row.length
    assert all(n <= 2048 for n in filled.values())
    return len(filled)


def test_op4_on_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = queries.op4_best_fit_packing(spark, SMALL).collect()
    sequences = checked_packing(rows, Counter((row.doc_id, row.text) for row in docs))
    assert sequences == packing.fewest_possible(Counter(row.length for row in rows), 2048)


def test_packing_of_awkward_rows(spark, awkward_wide, empty):
    rows = packing.packed(awkward_wide, WORDS).collect()
    checked_packing(rows, Counter((row[0], row[1]) for row in awkward_rows()))
    assert packing.packed(empty, WORDS).count() == 0


def test_bin_completion_keeps_every_piece():
    draw = random.Random(3)
    for _ in range(30):
        capacity = draw.choice([10, 100, 2048])
        histogram = {draw.randint(1, capacity): draw.randint(1, 50) for _ in range(draw.randint(1, 40))}
        found = packing.bin_completion(histogram, capacity)
        held = Counter()
        for times, filling in found:
            assert sum(filling) <= capacity
            held.update({length: times * count for length, count in Counter(filling).items()})
        assert held == Counter(histogram)
        bins = sum(times for times, _ in found)
        assert packing.fewest_possible(histogram, capacity) <= bins
        assert bins <= sum(times for times, _ in packing.best_fit(histogram, capacity))


def test_bin_completion_beats_best_fit():
    # Best fit puts 6 with 4 and strands the threes; three bins hold all.
    histogram = {6: 2, 4: 1, 3: 2, 2: 4}
    assert sum(times for times, _ in packing.bin_completion(histogram, 10)) == 3


def test_bin_completion_changes_the_first_bin():
    # The best filling of the largest length's bin leads to four bins.
    histogram = {19: 2, 18: 5, 8: 6}
    assert sum(times for times, _ in packing.bin_completion(histogram, 60)) == 3


def test_wavelet_matrix():
    values = np.random.default_rng(4).integers(0, 50, 3000).astype("<u4")
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(values, 16).to_bytes())
    places = np.arange(len(values))
    assert (matrix.everything() == values).all() and (matrix.access(places) == values).all()
    for value in (0, 7, 49, 50, 70_000):
        at = np.flatnonzero(values == value)
        for end in (0, 1, 8, 511, 512, 513, 2999, 3000):
            assert matrix.rank(value, end) == (at < end).sum()
        assert [matrix.select(value, nth) for nth in range(3)] == [
            *at[:3].tolist(),
            *[None] * (3 - len(at[:3])),
        ]


def wavelet_expected(rows) -> list[tuple]:
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    expected, start = [], 0
    for doc_id, text in ordered:
        ids = ids_of(text, 1)
        expected.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return expected


def test_op7_on_the_table(spark):
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = queries.op7_wavelet_matrix(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == wavelet_expected(docs)


def test_wavelet_of_awkward_rows(spark, awkward_wide, empty, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 5)
    rows = wavelet.read_back(wavelet.written(awkward_wide, WORDS)).collect()
    got = sorted(map(tuple, rows), key=lambda row: row[1])
    assert got == wavelet_expected([row[:2] for row in awkward_rows()])
    assert wavelet.read_back(wavelet.written(empty, WORDS)).count() == 0


def test_what_is_remembered_of_plain_texts_is_bounded(monkeypatch):
    for name in ("MOST_WORDS", "MOST_HEADS", "MOST_PAIRS"):
        monkeypatch.setattr(token_counts, name, 500)
    draw = random.Random(41)
    bounded, free = (token_counts.PrefixCounter(BYTES) for _ in range(2))
    for _ in range(6):
        batch = [" ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(100)) for _ in range(3)]
        found = bounded.all_counts(batch)
        monkeypatch.setattr(token_counts, "MOST_HEADS", 10**9)
        assert all((one == other).all() for one, other in zip(found, free.all_counts(batch)))
        monkeypatch.setattr(token_counts, "MOST_HEADS", 500)
        # A batch adds at most one head and one entry for each of its 300 words.
        assert len(bounded.heads) <= 500 + 300 and len(bounded.words) <= 500 + 300
        assert bounded.n_pairs <= 500 + 40 * 300
