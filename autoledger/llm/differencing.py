"""Packing of documents into near-equal windows by Karmarkar-Karp multiway differencing.

1. Each task encodes its documents. What fills whole windows of a long document is a window at once; the rest is cut into
   pieces, whose lengths run evenly through ``PIECES``, as differencing needs lengths of all kinds to end near equal. Short
   documents that follow each other stay together as one item.
2. Items are gathered in shards that fill ``WINDOWS`` windows up to ``FILL`` of their capacity; the last one is cut to fit.
3. Differencing deals a shard's items to its windows. Each item begins as a partition of its own, with one filled window
   and the others empty. Again and again the two partitions of the largest spread between windows are merged: the
   fullest window of one with the emptiest of the other, and so on, so that their imbalances cancel. What is left is one
   partition of near-equal windows. If its fullest is beyond the capacity, the number of windows rises by one and the shard is
   dealt anew, as long as padding stays below ``PADDING`` of the shard. A short shard cannot afford that: there, what is
   beyond the capacity is cut off and goes where there is room.
4. What a task has left in the end, less than a window beyond its last shard, goes into windows whose lengths are powers
   of two, which need no padding.

A shard is a few hundred thousand tokens, whatever the input's size: no task holds more, nothing is shuffled, and nothing
reaches the driver. A task that is run again gives the same windows, as its documents and their order are the same.

Cases: a null or empty text is the end token alone; ids may be null or repeated, each row is packed on its own; an empty
table packs into nothing; other columns are not read; a text of any length is cut, and only its own tokens are held.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .byte_tokens import byte_tokens
from .common import mapped, schema_of, slices, texts_of

CAPACITY = 2048
END_ID = 1
# Tokens of a piece at least and at most, as shares of a window.
PIECES = 1 / 32, 1 / 4
# Steps of this size, less whole numbers, fall evenly into any interval.
GOLDEN = (5**0.5 - 1) / 2
WINDOWS = 256
FILL = 511 / 512
# Padding, as a share of a shard, for which the number of windows may rise.
PADDING = 1 / 64


class Piece(NamedTuple):
    """Tokens of a document from ``start`` on; ``ids`` are bytes, four a token."""

    doc_id: str | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def parted(self, length: int) -> tuple[Piece, Piece]:
        doc_id, start, ids, doc_tokens = self
        head = Piece(doc_id, start, ids[: 4 * length], doc_tokens)
        return head, Piece(doc_id, start + length, ids[4 * length :], doc_tokens)


Item = list[Piece]


def length_of(item: Iterable[Piece]) -> int:
    return sum(piece.length for piece in item)


def dealt(sizes: list[int], windows: int) -> list[list[int]]:
    """The places of ``sizes`` in near-equal ``windows``, by multiway differencing.

    A partition is its windows' sums in descending order and, for each, a node: a place in ``sizes``, or a pair of nodes.
    """
    pairs: list[tuple[int, int]] = []
    partitions: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def taken(number: int) -> tuple[np.ndarray, np.ndarray]:
        if number in partitions:
            return partitions.pop(number)
        sums, nodes = np.zeros(windows, dtype=np.int64), np.full(windows, -1)
        sums[0], nodes[0] = sizes[number], number
        return sums, nodes

    if not sizes:
        return [[] for _ in range(windows)]
    spreads = [(-size if windows > 1 else 0, number) for number, size in enumerate(sizes)]
    heapq.heapify(spreads)
    made = len(sizes)
    while len(spreads) > 1:
        (sums, nodes), (other_sums, other_nodes) = taken(heapq.heappop(spreads)[1]), taken(heapq.heappop(spreads)[1])
        other = other_nodes[::-1]
        merged = np.where(nodes >= 0, nodes, other)
        both = np.flatnonzero((nodes >= 0) & (other >= 0))
        if len(both):
            merged[both] = len(sizes) + len(pairs) + np.arange(len(both))
            pairs.extend(zip(nodes[both].tolist(), other[both].tolist()))
        sums = sums + other_sums[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        partitions[made] = sums, merged[order]
        heapq.heappush(spreads, (int(sums[-1] - sums[0]), made))
        made += 1
    _, nodes = taken(spreads[0][1])

    def places(node: int) -> Iterator[int]:
        waiting = [node]
        while waiting:
            node = waiting.pop()
            if node >= len(sizes):
                waiting.extend(pairs[node - len(sizes)][::-1])
            elif node >= 0:
                yield node

    return [list(places(node)) for node in nodes.tolist()]


def levelled(windows: list[list[Piece]], capacity: int) -> list[list[Piece]]:
    """The windows with what they hold beyond the capacity moved to where there is room, the emptiest first."""
    beyond: Item = []
    fitting = []
    for window in windows:
        parts = split_at([[piece] for piece in window], capacity)
        inside, outside = ([piece for item in part for piece in item] for part in parts)
        fitting.append(inside)
        beyond += outside
    left = [beyond] if beyond else []
    for window in sorted(fitting, key=length_of):
        part, left = split_at(left, capacity - length_of(window))
        window += [piece for item in part for piece in item]
    return fitting


def windows_of(items: list[Item], capacity: int) -> list[list[Piece]]:
    """The items in near-equal windows, as few as differencing can fill without going beyond the capacity."""
    sizes = [length_of(item) for item in items]
    total = sum(sizes)
    fewest = -(-total // capacity)
    most = max(fewest, int(total * (1 + PADDING)) // capacity)
    found: list[list[Piece]] = []
    for windows in range(fewest, most + 1):
        dealt_out = dealt(sizes, windows)
        found = [[piece for place in window for piece in items[place]] for window in dealt_out]
        if max(map(length_of, found), default=0) <= capacity:
            break
    else:
        found = [[piece for place in window for piece in items[place]] for window in dealt(sizes, fewest)]
        found = levelled(found, capacity)
    return [window for window in found if window]


def split_at(items: list[Item], length: int) -> tuple[list[Item], list[Item]]:
    """The first ``length`` tokens of the items, and the others."""
    head: list[Item] = []
    for place, item in enumerate(items):
        if length <= 0:
            return head, items[place:]
        size = length_of(item)
        if size > length:
            first: Item = []
            rest: Item = []
            for piece in item:
                inside, outside = piece.parted(max(0, min(length, piece.length)))
                length -= inside.length
                first += [inside] * (inside.length > 0)
                rest += [outside] * (outside.length > 0)
            return [*head, first], [rest, *items[place + 1 :]]
        head.append(item)
        length -= size
    return head, []


def powers(items: list[Item]) -> Iterator[list[Piece]]:
    """The items in windows whose lengths are powers of two, the longest first."""
    left = sum(map(length_of, items))
    while left:
        size = 1 << (left.bit_length() - 1)
        head, items = split_at(items, size)
        yield [piece for item in head for piece in item]
        left -= size


class Shards:
    """Takes documents and gives windows, in lists of pieces."""

    def __init__(self, capacity: int, windows: int) -> None:
        self.capacity = capacity
        self.least, self.most = (max(1, int(capacity * share)) for share in PIECES)
        self.fill = max(1, int(capacity * FILL))
        self.windows = windows
        self.items: list[Item] = []
        self.held = self.last = 0
        self.place = 0.0

    def add(self, doc_id: str | None, ids: bytes) -> Iterator[list[Piece]]:
        left = Piece(doc_id, 0, ids, len(ids) // 4)
        while left.length >= self.capacity:
            whole, left = left.parted(self.capacity)
            yield [whole]
        self.held += left.length
        while left.length:
            self.place = (self.place + GOLDEN) % 1
            length = self.least + int(self.place * (self.most - self.least))
            if left.length < length + self.least:
                length = left.length
            piece, left = left.parted(length)
            if self.items and self.last < self.least:
                self.items[-1].append(piece)
                self.last += length
            else:
                self.items.append([piece])
                self.last = length
        if self.held >= self.windows * self.fill:
            yield from self.closed(self.windows)

    def closed(self, windows: int) -> Iterator[list[Piece]]:
        """The windows of the first ``windows * fill`` tokens."""
        shard, self.items = split_at(self.items, windows * self.fill)
        self.held -= windows * self.fill
        self.last = length_of(self.items[-1]) if self.items else 0
        yield from windows_of(shard, self.capacity)

    def rest(self) -> Iterator[list[Piece]]:
        yield from self.closed(self.held // self.fill)
        yield from powers(self.items)


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    windows: int = WINDOWS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece, with its ``sequence_id`` and its ``offset`` there; ``windows`` is how many a shard fills."""
    rows = texts_of(docs, id, text)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, shards = byte_tokens(tokenizer), Shards(capacity, windows)
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32

        def placed(made: Iterable[list[Piece]]) -> pd.DataFrame:
            nonlocal sequence
            found = []
            for window in made:
                offset = 0
                for piece in window:
                    crc = zlib.crc32(piece.ids)
                    found.append((piece.doc_id, piece.start, piece.length, crc, piece.doc_tokens, sequence, offset))
                    offset += piece.length
                sequence += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pd.DataFrame(found, columns=names)

        for frame in slices(frames, "text"):
            encoded = zip(frame["doc_id"], encoder.encode(frame["text"]))
            yield placed(window for doc_id, ids in encoded for window in shards.add(doc_id, ids + end))
        yield placed(shards.rest())

    fields = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return mapped(rows, pack, schema_of(rows, fields))
