"""Token ids as wavelet matrices, one per shard.

A wavelet matrix keeps a sequence of integers as bit planes, from the highest bit down; after each plane the
sequence is parted by that bit, zeros first, order kept. With counts of ones at fixed steps, each plane answers
``rank`` at once and ``select`` by search, and so the matrix gives the token at any place, the number of
occurrences of a token before any place, and the place of its n-th occurrence, without being unpacked.

A shard is one row of a Parquet file that Spark writes: a failed task leaves no half-written shard, and any store
that Spark reaches will do. Its ``planes`` column is the whole matrix. Documents are in ascending order of
their id, never split, and a shard is closed once it has ``SHARD_TOKENS``; a longer document is a shard alone.

Cases: a null or empty text is the end token alone; null ids come first; repeated ids keep to the order of their
texts; an empty table gives no shard; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped, slices, stored, texts_of
from .word_tokens import word_tokens

END_ID = 1
SHARD_TOKENS = 1 << 19
# Bits between two stored counts of ones.
STEP = 512


@dataclass(frozen=True)
class WaveletMatrix:
    """``n`` integers below ``2 ** len(planes)``: packed bits and number of zeros, plane by plane."""

    n: int
    planes: tuple[np.ndarray, ...]
    zeros: tuple[int, ...]

    @staticmethod
    def of(values: np.ndarray, bits: int) -> WaveletMatrix:
        values = values.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for shift in range(bits - 1, -1, -1):
            bit = (values & values.dtype.type(1 << shift)).astype(bool)
            planes.append(np.packbits(bit))
            # Places first: on arbitrary bits this is faster than a mask.
            parted = values.take(np.flatnonzero(~bit))
            zeros.append(len(parted))
            values = np.concatenate([parted, values.take(np.flatnonzero(bit))])
        return WaveletMatrix(len(values), tuple(planes), tuple(zeros))

    @cached_property
    def counts(self) -> tuple[np.ndarray, ...]:
        return tuple(map(self.ones_before, self.planes))

    @staticmethod
    def ones_before(plane: np.ndarray) -> np.ndarray:
        """Ones before each multiple of ``STEP`` bits."""
        ones = np.bitwise_count(plane).astype(np.int64)
        at = np.arange(0, len(plane) + STEP // 8, STEP // 8)
        return np.concatenate([[0], np.cumsum(ones)])[np.minimum(at, len(plane))]

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.planes), *self.zeros], dtype="<u8").tobytes()
        return head + b"".join(plane.tobytes() for plane in self.planes)

    @staticmethod
    def from_bytes(data: bytes) -> WaveletMatrix:
        n, bits = (int(value) for value in np.frombuffer(data, "<u8", 2))
        zeros = tuple(int(value) for value in np.frombuffer(data, "<u8", bits, 16))
        size, begin = (n + 7) // 8, 16 + 8 * bits
        planes = tuple(
            np.frombuffer(data, np.uint8, size, begin + level * size) for level in range(bits)
        )
        return WaveletMatrix(n, planes, zeros)

    def bits_at(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3] >> (7 - (at & 7))) & 1

    def rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place: the stored count, whole bytes since, and the first bits of the last one."""
        plane = self.planes[level]
        step = at // STEP
        ones = self.counts[level][step].astype(np.int64)
        first = step * (STEP // 8)
        whole = (at >> 3) - first
        for byte in range(STEP // 8):
            more = byte < whole
            if not more.any():
                break
            ones[more] += np.bitwise_count(plane[(first + byte)[more]])
        rest = (at & 7) > 0
        last = plane[(at >> 3)[rest]] >> (8 - (at & 7)[rest]).astype(np.uint8)
        ones[rest] += np.bitwise_count(last)
        return ones

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at some places."""
        at = np.asarray(at, dtype=np.int64)
        values = np.zeros(len(at), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            bit = self.bits_at(level, at)
            ones = self.rank1(level, at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            values = (values << 1) | bit
        return values

    def everything(self) -> np.ndarray:
        """All values, in order: from the lowest plane up, what was parted by its bits is put together again."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, dtype=kind)
        for shift, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            bit = np.unpackbits(plane, count=self.n).view(bool)
            joined = np.empty_like(values)
            joined[np.flatnonzero(~bit)] = values[:zeros]
            joined[np.flatnonzero(bit)] = values[zeros:] | kind(1 << shift)
            values = joined
        return values

    def rank(self, value: int, end: int) -> int:
        """Occurrences of ``value`` before place ``end``."""
        if value < 0 or value >> len(self.planes):
            return 0
        span = np.array([0, end], dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            ones = self.rank1(level, span)
            bit = (value >> (len(self.planes) - 1 - level)) & 1
            span = zeros + ones if bit else span - ones
        return int(span[1] - span[0])

    def select(self, value: int, nth: int) -> int | None:
        """The place of the ``nth`` occurrence, from 0; None if there are fewer."""
        if nth < 0 or nth >= self.rank(value, self.n):
            return None
        low, high = 0, self.n - 1
        while low < high:
            middle = (low + high) // 2
            if self.rank(value, middle + 1) > nth:
                high = middle
            else:
                low = middle + 1
        return low


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Shards of the documents in ascending order of their ids.

    A row holds the range partition it is from, its number there, the ids and token counts of its documents,
    and its matrix.
    """
    ordered = (
        docs.repartitionByRange(F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        .withColumn("part", F.spark_partition_id())
    )
    id_type = docs.schema["doc_id"].dataType

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_tokens(tokenizer)
        bits = max(1, (encoder.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        end = np.array([end_id], dtype="<u4").tobytes()
        ids, sizes, tokens, held, number, part = [], [], [], 0, 0, 0

        def closed() -> pd.DataFrame:
            values = np.concatenate([np.frombuffer(one, dtype="<u4") for one in tokens])
            matrix = WaveletMatrix.of(values, bits).to_bytes()
            row = {"part": part, "number": number, "doc_ids": [ids], "n_tokens": [sizes], "planes": [matrix]}
            return pd.DataFrame(row)

        for frame in slices(frames, "text"):
            part = int(frame["part"].iloc[0])
            for doc_id, one in zip(frame["doc_id"].astype(object), encoder.encode(frame["text"])):
                ids.append(None if pd.isna(doc_id) else doc_id)
                tokens.append(one + end)
                sizes.append(len(one) // 4 + 1)
                held += sizes[-1]
                if held >= SHARD_TOKENS:
                    yield closed()
                    ids, sizes, tokens, held, number = [], [], [], 0, number + 1
        if ids:
            yield closed()

    fields = T.StructType.fromDDL("part int, number int, n_tokens array<long>, planes binary")
    fields = fields.add("doc_ids", T.ArrayType(id_type, True))
    names = ["part", "number", "doc_ids", "n_tokens", "planes"]
    result = T.StructType([fields[name] for name in names])
    return mapped(ordered, shards, result)


def read_back(shards: DataFrame) -> DataFrame:
    """Per document of the shards: ``start``, the tokens of all before it, ``n_tokens`` and ``ids_crc32``."""
    sizes = shards.select(
        "part", "number", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("tokens")
    )
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # One number per range partition, the only rows that one task sees together.
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("part").alias("_part"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_start")
    )
    starts = sizes.join(parts, F.col("part") == F.col("_part")).select(
        F.col("part").alias("_part"),
        F.col("number").alias("_number"),
        (F.col("part_start") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).cast("long").alias("start"),
    )
    id_type = shards.schema["doc_ids"].dataType.elementType

    def checked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                values = WaveletMatrix.from_bytes(row.planes).everything().astype("<u4")
                ends = np.cumsum(np.asarray(row.n_tokens))
                sums = [zlib.crc32(one.tobytes()) for one in np.split(values, ends[:-1])]
                yield pd.DataFrame(
                    {
                        "part": row.part,
                        "number": row.number,
                        "doc_id": pd.Series(list(row.doc_ids), dtype=object),
                        "offset": ends - np.asarray(row.n_tokens),
                        "n_tokens": row.n_tokens,
                        "ids_crc32": sums,
                    }
                )

    fields = T.StructType.fromDDL("part int, number int, offset long, n_tokens long, ids_crc32 long")
    documents = mapped(shards, checked, fields.add("doc_id", id_type))
    same = (F.col("part") == F.col("_part")) & (F.col("number") == F.col("_number"))
    return documents.join(starts, same).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def written(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The shards, written to the shared folder and read from there."""
    return stored(encoded(texts_of(docs, id, text), tokenizer, end_id), "shards")
