"""Token ids of whole texts under a byte-level vocabulary, word by word; see ``word_tokens``.

A word of the split pattern is encoded alone, so ids of distinct words are found once per worker. Texts whose split could
differ from the library's are given to the library whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate

import numpy as np

from .token_counts import EDGE, spans
from .word_tokens import LETTERS, WordTokens, word_numbers


# A space and letters: words that stay words when they follow each other.
SPACED = re.compile(f" [{LETTERS}]+")
# Fixed value: how the vocabulary spells a space.
SPACE_LETTER = "Ġ"


class ByteTokens(WordTokens):
    """Little-endian unsigned 32-bit ids of texts, as bytes."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins_word[[id for token, id in vocabulary.items() if token.startswith(SPACE_LETTER)]] = True

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words: those of a space and letters are encoded as one text, and parted before tokens with a space."""
        is_spaced = [SPACED.fullmatch(word) is not None for word in words]
        spaced = [word for word, yes in zip(words, is_spaced) if yes]
        other = iter(self.library([word for word, yes in zip(words, is_spaced) if not yes]))
        (encoding,) = self.tokenizer.encode_batch_fast(["".join(spaced)], add_special_tokens=False)
        ids = np.array(encoding.ids, dtype="<u4")
        starts = (4 * np.flatnonzero(self.begins_word[ids])).tolist()
        if len(starts) != len(spaced):
            return self.library(words)
        data = ids.tobytes()
        joined = (data[start:end] for start, end in zip(starts, [*starts[1:], len(data)]))
        return [next(joined) if yes else next(other) for yes in is_spaced]

    def of_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are split here as in the library."""
        data = f"{EDGE}{EDGE.join(texts)}{EDGE}".encode("latin-1")
        starts, ends, _, _ = spans(np.frombuffer(data, dtype=np.uint8))
        numbers, first = word_numbers(data, starts, ends)
        words = [data[start:end] for start, end in zip(starts[first].tolist(), ends[first].tolist())]
        # What stands between texts has no ids.
        self.known[EDGE.encode()] = b""
        of_word = self.ids_of_distinct(words)
        ids = np.frombuffer(b"".join(of_word), dtype="<u4")
        sizes = np.fromiter(map(len, of_word), dtype=np.int64, count=len(of_word)) // 4
        begins = np.cumsum(sizes) - sizes
        size = sizes[numbers]
        until = np.concatenate([[0], np.cumsum(size)])
        ids = ids[np.repeat(begins[numbers] - until[:-1], size) + np.arange(until[-1])]
        edges = list(accumulate((len(text) + 1 for text in texts), initial=0))
        cuts = until[np.searchsorted(starts, edges)].tolist()
        return [ids[start:end].tobytes() for start, end in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    """One per worker process and vocabulary file."""
    return ByteTokens(path)
