"""Token ids of whole texts, word by word: what a tokenizer gives for a word does not depend on its neighbours.

A tokenizer splits a text into words by a pattern and merges within each. Natural text repeats its words, so
each distinct word is encoded once per worker and a text is the concatenation of its words' ids. A batch of texts
is split and numbered by array operations, so only its distinct words are ever strings. Texts for
which the split could differ from the library's (characters beyond Latin-1, or a special token's string)
are given to the library whole, so ids are always the library's.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

# Characters on which all engines agree: letters, digits, marks and plain white space of Latin-1.
UNSAFE = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xff]")
# The letters and numbers among them, and how the word-level vocabulary splits a text of them after
# white space and case are unified: words, single digits, contractions, runs of marks.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
CONTRACTIONS = "'(?:[stmd]|re|ve|ll)"
# Kinds of the characters by code point.
SPACE, LETTER, NUMBER, MARK = range(4)
KINDS = np.array(
    [
        LETTER if re.match(f"[{LETTERS}]", char) else NUMBER if re.match(f"[{NUMBERS}]", char) else MARK
        for char in map(chr, range(256))
    ],
    dtype=np.uint8,
)
KINDS[list(b"\t\n\r ")] = SPACE
APOSTROPHE = ord("'")
# Fixed value: what tokens at the end of a word end with.
WORD_END = "</w>"
# Words remembered by a worker: about 100 MB.
MOST_WORDS = 500_000
# Words of more bytes are compared as strings.
LONG_WORD = 64


class WordTokens:
    """Little-endian unsigned 32-bit ids of texts, as bytes."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[id for token, id in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def plain(self, text: str) -> bool:
        return UNSAFE.search(text) is None and not any(special in text for special in self.specials)

    def library(self, texts: list[str]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, dtype="<u4").tobytes() for encoding in encodings]

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words: encoded as one text and parted after tokens that end a word."""
        (encoding,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(encoding.ids, dtype="<u4")
        ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
        if len(ends) != len(words):
            return self.library(words)
        data, starts = ids.tobytes(), [0, *ends[:-1].tolist()]
        return [data[start:end] for start, end in zip(starts, ends.tolist())]

    def ids_of_distinct(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words. Words not asked for in a while are forgotten, frequent ones stay."""
        if len(self.known) > MOST_WORDS // 2:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        missing = []
        for word in words:
            if word not in known:
                if word in before:
                    known[word] = before[word]
                else:
                    missing.append(word)
        if missing:
            known.update(zip(missing, self.of_words([word.decode("latin-1") for word in missing])))
        return [known[word] for word in words]

    def of_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are split here as in the library."""
        data = "\n".join(texts).lower().encode("latin-1")
        starts, ends = word_spans(np.frombuffer(data, dtype=np.uint8))
        numbers, first = word_numbers(data, starts, ends)
        spans = zip(starts[first].tolist(), ends[first].tolist())
        of_word = self.ids_of_distinct([data[start:end] for start, end in spans])
        ids = np.frombuffer(b"".join(of_word), dtype="<u4")
        sizes = np.fromiter(map(len, of_word), dtype=np.int64, count=len(of_word)) // 4
        begins = np.cumsum(sizes) - sizes
        size = sizes[numbers]
        until = np.concatenate([[0], np.cumsum(size)])
        ids = ids[np.repeat(begins[numbers] - until[:-1], size) + np.arange(until[-1])]
        # A text's words are those that start before its end; each is followed by one line break.
        text_ends = list(accumulate(len(text) + 1 for text in texts))
        cuts = until[np.searchsorted(starts, text_ends)].tolist()
        return [ids[start:end].tobytes() for start, end in zip([0, *cuts], cuts)]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        texts = list(texts)
        plain = [self.plain(text) for text in texts]
        split = iter(self.of_plain([text for text, is_plain in zip(texts, plain) if is_plain]))
        whole = iter(self.library([text for text, is_plain in zip(texts, plain) if not is_plain]))
        return [next(split if is_plain else whole) for is_plain in plain]


def join_contractions(chars: np.ndarray, new: np.ndarray) -> None:
    """An apostrophe that begins a word takes the letters of a contraction along."""
    at = np.flatnonzero((chars == APOSTROPHE) & new)
    after = np.concatenate([chars, np.zeros(2, dtype=np.uint8)])
    one, two = after[at + 1], after[at + 2]
    short = np.isin(one, list(b"stmd"))
    pairs = one.astype(np.uint16) << 8 | two
    long = np.isin(pairs, [first << 8 | second for first, second in (b"re", b"ve", b"ll")])
    new[at[short | long] + 1] = False
    for size, which in ((2, short), (3, long)):
        ends = at[which] + size
        ends = ends[ends < len(chars)]
        new[ends] = True


def word_spans(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end, in lower-case Latin-1 characters."""
    kinds = KINDS[chars]
    new = np.ones(len(chars), dtype=bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    join_contractions(chars, new)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(chars))
    words = kinds[starts] != SPACE
    return starts[words], ends[words]


def word_numbers(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word a number, the same for equal words, and per number the place of one such word.

    Words are compared eight bytes at a time; no word holds a zero byte. Very long ones are compared whole.
    """
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8)
    eight = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))

    def part(of: np.ndarray, offset: int) -> np.ndarray:
        begin = starts[of] + offset
        held = np.minimum(ends[of] - begin, 8).astype(np.uint64)
        values = eight[begin].view("<u8").ravel()
        return pd.factorize(values & (np.uint64(2**64 - 1) >> (np.uint64(8) * (np.uint64(8) - held))))[0]

    length = ends - starts
    numbers = part(np.arange(len(starts)), 0)
    for offset in range(8, LONG_WORD, 8):
        longer = np.flatnonzero((length > offset) & (length <= LONG_WORD))
        if not len(longer):
            break
        tails = part(longer, offset)
        both = pd.factorize(numbers[longer] * (tails.max() + 1) + tails)[0]
        numbers[longer] = numbers.max() + 1 + both
    huge = np.flatnonzero(length > LONG_WORD)
    if len(huge):
        spelled = np.empty(len(huge), dtype=object)
        spelled[:] = [data[starts[word] : ends[word]] for word in huge.tolist()]
        numbers[huge] = numbers.max() + 1 + pd.factorize(spelled)[0]
    first = np.full(numbers.max(initial=-1) + 1, -1)
    first[numbers] = np.arange(len(numbers))
    held = first >= 0
    return (np.cumsum(held) - 1)[numbers], first[held]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per worker process and vocabulary file."""
    return WordTokens(path)
