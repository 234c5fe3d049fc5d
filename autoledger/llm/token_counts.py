"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

A byte-level BPE encodes each word of its split pattern alone. Within a word, the encoding of a prefix ends in
exactly one token whose predecessor is the last token of the encoding of what is before it, and a pair of tokens
may stand side by side just if the merges, applied to their joined text, give back these two. So the last
token and the count of each prefix follow from those of shorter prefixes, at a few lookups a byte, and no
prefix is ever encoded. Counts of a text's prefixes are those of its words, laid end to end; the only other
case is a prefix that ends in a run of white space, which the pattern takes as one word.

With the counts stored, questions about truncation and budgets are array lookups: see ``tokens_in_prefix`` and
``longest_prefix``. Counts may fall from one prefix to the next, as a longer prefix may need fewer tokens.

Cases: a null or empty text has the one count 0; a special token's string within a text is one token, as the
library takes it by default; rows are answered one by one, so repeated and null ids are no special case; other
columns are not read. Long texts are taken in bounded batches.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .common import by_slice, mapped, schema_of, texts_of
from .word_tokens import (
    CONTRACTIONS,
    KINDS,
    LETTERS,
    NUMBERS,
    SPACE,
    UNSAFE,
    join_contractions,
    word_numbers,
)

# Fixed value: how the byte-level vocabulary splits a text of Latin-1 characters. Letters, numbers and marks take
# one space before them along; of white space before them, all but the last character is a word.
SPLIT_PATTERN = (
    rf" ?[{LETTERS}]+| ?[{NUMBERS}]+|{CONTRACTIONS}| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)
# White space as the library's pattern knows it.
SPACES = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# What stands between texts that are taken together.
EDGE = "\0"
EDGE_KIND = 4
KINDS_AND_EDGE = np.concatenate([[EDGE_KIND], KINDS[1:]]).astype(np.uint8)
# Letters after which the states of a word's prefixes are kept for others.
HEAD = 7
# What a worker remembers, about 100 MB of each.
MOST_WORDS = 500_000
MOST_HEADS = 250_000
MOST_PAIRS = 1_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte value in the vocabulary: itself if it can be seen, else one beyond."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {value: chr(value) for value in visible}
    hidden = (value for value in range(256) if value not in letters)
    letters.update({value: chr(0x100 + place) for place, value in enumerate(hidden)})
    return [letters[value] for value in range(256)]


class KnownWords(dict[str, bytes]):
    """Counts by word, found out where they are first asked for, forgotten if not asked for in a while."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        self.find = find
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        self[word] = counts = self.before.get(word) or self.find(word)
        return counts

    def forget(self, most: int) -> None:
        """Keeps about ``most`` words at the utmost; those asked for since the last time stay."""
        if len(self) > most // 2:
            self.before = dict(self)
            self.clear()


class PrefixCounter:
    """Counts of all prefixes of a text under one vocabulary file."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.tokens = vocabulary
        self.stems = {token[:end] for token in vocabulary for end in range(1, len(token) + 1)}
        self.pattern = re.compile(SPLIT_PATTERN)
        self.space_run = re.compile(f"[{SPACES}]{{2,}}")
        self.specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_pattern = re.compile("|".join(re.escape(text) for text in self.specials))
        self.pairs: dict[str, dict[str, bool]] = defaultdict(dict)
        self.n_pairs = 0
        self.heads: dict[str, tuple[tuple[str, ...], tuple[int, ...]]] = {}
        self.words = KnownWords(self.spelled_counts)
        self.split = ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)

    def fit_together(self, left: str, right: str) -> bool:
        """Whether the encoding of the joined text is these two tokens; with ``left`` empty, this one."""
        wanted = [left, right] if left else [right]
        fits = [token.value for token in self.model.tokenize(left + right)] == wanted
        self.pairs[left][right] = fits
        self.n_pairs += 1
        return fits

    def word_counts(self, word: str) -> array:
        """The counts of the prefixes of one word, one per character."""
        spelled = word.encode().decode("latin-1").translate(self.letters)
        size = len(spelled)
        # Words that begin alike share the states of their first prefixes.
        head = self.heads.get(spelled[:HEAD])
        last, count = (list(head[0]), list(head[1])) if head else ([""], [0])
        tokens, stems, pairs = self.tokens, self.stems, self.pairs
        known = [pairs[token] for token in last]
        low = 0
        for end in range(len(last), size + 1):
            # No token that begins before this place goes on to here, nor will one that goes on beyond.
            while spelled[low:end] not in stems:
                low += 1
            for start in range(low, end):
                token = spelled[start:end]
                if token in tokens:
                    fits = known[start].get(token)
                    if fits is None:
                        fits = self.fit_together(last[start], token)
                    if fits:
                        last.append(token)
                        known.append(pairs[token])
                        count.append(count[start] + 1)
                        break
            if end == HEAD:
                self.heads[spelled[:HEAD]] = (tuple(last), tuple(count))
        if size == len(word):
            return array("i", count[1:])
        return array("i", [count[end] for end in accumulate(len(letter.encode()) for letter in word)])

    def spelled_counts(self, word: str) -> bytes:
        if len(word) > 1 and word[0] == "'" and word[1].isalpha():
            # A contraction cut short is an apostrophe and letters: two words.
            (mark,) = self.word_counts("'")
            cut = array("i", [mark, *(mark + count for count in self.word_counts(word[1:]))])
            cut[-1] = self.word_counts(word)[-1]
            return cut.tobytes()
        return self.word_counts(word).tobytes()

    def ordinary(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 1, 2, ... characters of a text without special tokens."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        if UNSAFE.search(text) is None:
            words = self.pattern.findall(text)
        else:
            words = [text[start:end] for _, (start, end) in self.split.pre_tokenize_str(text)]
        known = self.words.__getitem__
        counts = np.frombuffer(bytearray().join(map(known, words)), dtype=np.int32)
        sizes = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
        totals = counts[np.cumsum(sizes) - 1]
        counts += np.repeat(np.cumsum(totals, dtype=np.int32) - totals, sizes)
        for run in self.space_run.finditer(text):
            start, end = run.span()
            before = counts[start - 1] if start else 0
            alone = np.frombuffer(known(run.group()), dtype=np.int32)
            counts[end - 1] = before + alone[-1]
        return counts

    def of_plain(self, texts: list[str]) -> list[np.ndarray]:
        """``counts`` of texts of Latin-1 characters without special tokens, by array operations on all of them."""
        data = f"{EDGE}{EDGE.join(texts)}{EDGE}".encode("latin-1")
        starts, ends, run_starts, run_ends = spans(np.frombuffer(data, dtype=np.uint8))

        def found(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """Per word its number; per number the counts laid end to end, where they begin, and the last one."""
            numbers, first = word_numbers(data, starts, ends)
            words = [data[start:end] for start, end in zip(starts[first].tolist(), ends[first].tolist())]
            known = [
                bytes(4) if word == EDGE.encode() else self.words[word.decode("latin-1")] for word in words
            ]
            counts = np.frombuffer(b"".join(known), dtype=np.int32)
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            until = np.cumsum(sizes)
            return numbers, counts, until - sizes, counts[until - 1]

        numbers, counts, begins, totals = found(starts, ends)
        total = totals[numbers]
        sizes = ends - starts
        result = counts[np.repeat(begins[numbers] - starts, sizes) + np.arange(len(data))]
        result += np.repeat(np.cumsum(total, dtype=np.int32) - total, sizes)
        if len(run_starts):
            numbers, _, _, totals = found(run_starts, run_ends)
            result[run_ends - 1] = result[run_starts - 1] + totals[numbers]
        edges = list(accumulate((len(text) + 1 for text in texts), initial=0))
        return [result[start:end] - result[start] for start, end in zip(edges, edges[1:])]

    def forget(self) -> None:
        """Keeps what is remembered within bounds, but for what one batch adds."""
        self.words.forget(MOST_WORDS)
        if len(self.heads) > MOST_HEADS:
            self.heads.clear()
        if self.n_pairs > MOST_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0

    def all_counts(self, texts: list[str]) -> list[np.ndarray]:
        """``counts`` of each text."""
        self.forget()
        plain = [
            UNSAFE.search(text) is None and not ("<" in text and self.special_pattern.search(text))
            for text in texts
        ]
        together = iter(self.of_plain([text for text, is_plain in zip(texts, plain) if is_plain]))
        return [next(together) if is_plain else self.counts(text) for text, is_plain in zip(texts, plain)]

    def counts(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 0, 1, 2, ... characters of a text."""
        self.forget()
        parts, total, place = [np.zeros(1, dtype=np.int32)], 0, 0
        found = self.special_pattern.finditer(text) if "<" in text else ()
        for special in found:
            start, end = special.span()
            # Until its last character a special token's string is ordinary text.
            part = self.ordinary(text[place : end - 1])
            whole = 1 + (part[start - place - 1] if start > place else 0)
            parts += [total + part, np.array([total + whole], dtype=np.int32)]
            total, place = int(total + whole), end
        parts.append(total + self.ordinary(text[place:]))
        return np.concatenate(parts)


def spans(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of Latin-1 texts between edges, each edge a word of its own.

    Also starts and ends of runs of white space, of two and more, that other characters follow in their text.
    """
    kinds = KINDS_AND_EDGE[chars]
    new = np.ones(len(chars), dtype=bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == EDGE_KIND)
    run_starts = np.flatnonzero(new & (kinds == SPACE))
    run_ends = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE)) + 1
    followed = kinds[run_ends] != EDGE_KIND
    run_starts, run_ends = run_starts[followed], run_ends[followed]
    # The last character of a run before a word is apart, and part of that word if it is a space.
    new[run_ends - 1] = True
    new[run_ends[chars[run_ends - 1] == ord(" ")]] = False
    join_contractions(chars, new)
    starts = np.flatnonzero(new)
    long = run_ends - run_starts > 1
    return starts, np.append(starts[1:], len(chars)), run_starts[long], run_ends[long]


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One per worker process and vocabulary file."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_bytes`` and ``prefix_tokens``, the token counts of its prefixes of 0, 1, ... characters.

    ``tokenizer`` is the path of a byte-level vocabulary file, the same on every executor.
    """
    rows = texts_of(docs, id, text)

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        counter = prefix_counter(tokenizer)
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"],
                "n_bytes": [len(text.encode()) for text in frame["text"]],
                "prefix_tokens": counter.all_counts(frame["text"].tolist()),
            }
        )

    fields: T.StructType = schema_of(rows, "n_bytes long, prefix_tokens array<int>")
    return mapped(rows, by_slice(counted), fields)


def tokens_in_prefix(prefix_tokens: Column, n_chars: Column) -> Column:
    """Tokens of the prefix of so many characters; of the whole text if it is no longer."""
    return F.get(prefix_tokens, F.least(n_chars, F.size(prefix_tokens) - 1))


def tokens_in_all(prefix_tokens: Column) -> Column:
    return F.element_at(prefix_tokens, -1)


def longest_prefix(prefix_tokens: Column, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    whole = F.size(prefix_tokens) - 1
    within = F.transform(prefix_tokens, lambda count: count <= budget)
    last = F.size(prefix_tokens) - F.array_position(F.reverse(within), True)
    return F.when(tokens_in_all(prefix_tokens) <= budget, whole).otherwise(last).cast("int")
