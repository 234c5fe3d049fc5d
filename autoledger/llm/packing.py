"""Best-fit packing of documents into token sequences by bin completion.

1. Each task encodes its documents, cuts those that are too long into pieces, and numbers its pieces of each
   length; nothing but lengths and check sums leaves it.
2. Pieces of one length are interchangeable, so the packing is decided on the histogram of lengths: at most as
   many numbers as a sequence has tokens, however many documents there are. Only this reaches the driver.
3. Bin completion takes the largest length left and enumerates the undominated fillings of the rest of its
   bin, each used as often as the histogram allows; a branch that must waste more than the best solution so far
   is pruned. Best-fit decreasing gives the first solution. The search is bounded in steps and keeps the best.
4. The solution is a list of patterns with multiplicities. A piece finds its sequence from its length and its
   number among pieces of this length: sums per task and length, which no hot length can make uneven.

Cases: a null or empty text is the end token alone; ids may be null or repeated, each row is packed on its
own; an empty table packs into nothing; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, schema_of, slices, stored, texts_of
from .word_tokens import word_tokens

CAPACITY = 2048
END_ID = 0
# Bounds of the search: steps for one filling, and steps in all after the first dive.
FILLING_STEPS = 2_000
ALL_STEPS = 200_000

Filling = tuple[int, ...]
Packing = list[tuple[int, Filling]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: its place in its document, its check sum, and its number in its task and length."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task = word_tokens(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        seen: Counter[int] = Counter()
        for frame in slices(frames, "text"):
            rows = []
            for doc_id, ids in zip(frame["doc_id"], encoder.encode(frame["text"])):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc_id, piece, start // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            columns = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
            yield pd.DataFrame(rows, columns=columns)

    fields = "piece int, start long, length int, ids_crc32 long, task int, number long"
    return mapped(docs, cut, schema_of(docs, fields))


def best_fit(histogram: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing on counts: each length goes to the fullest bins that still take it."""
    groups: dict[int, Counter[Filling]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((room for room in groups if room >= length), default=None)
            if room is None:
                each = capacity // length
                for per_bin, bins in ((each, left // each), (left % each, 1)):
                    if per_bin and bins:
                        rest = capacity - per_bin * length
                        groups.setdefault(rest, Counter())[(length,) * per_bin] += bins
                break
            filling, bins = next(iter(groups[room].items()))
            each = min(room // length, max(1, left // bins))
            used = min(bins, left // each)
            groups[room][filling] -= used
            if not groups[room][filling]:
                del groups[room][filling]
                if not groups[room]:
                    del groups[room]
            groups.setdefault(room - each * length, Counter())[filling + (length,) * each] += used
            left -= each * used
    return [(bins, filling) for group in groups.values() for filling, bins in group.items()]


def fillings(
    histogram: dict[int, int], lengths: list[int], room: int, most: int, most_steps: int = FILLING_STEPS
) -> tuple[list[Filling], int]:
    """Undominated fillings of ``room``, those that waste least first, at most ``most``.

    Lengths go from large to small. A filling that leaves room for a length still at hand is dominated by the
    one with that length added, so only fillings with room for nothing else are kept; a branch that cannot
    waste less than the fillings in hand is cut. Also returns the steps taken.
    """
    found: list[tuple[int, Filling]] = []
    smallest = lengths[0] if lengths else 0
    steps = 0

    def extend(rest: int, below: int, taken: tuple[int, ...]) -> bool:
        nonlocal steps
        steps += 1
        if steps > most_steps:
            if not found:
                found.append((rest, taken))
            return True
        place = bisect_left(lengths, min(rest, below) + 1) - 1
        tried = False
        while place >= 0:
            length = lengths[place]
            if taken.count(length) < histogram[length]:
                tried = True
                if extend(rest - length, length, (*taken, length)):
                    return True
                if len(found) >= most and found[-1][0] == 0:
                    return True
            place -= 1
        if not tried and (rest < smallest or not taken or not fits_more(rest, taken)):
            found.append((rest, taken))
            found.sort(key=lambda entry: entry[0])
            del found[most:]
        return len(found) >= most and found[-1][0] == 0

    def fits_more(rest: int, taken: tuple[int, ...]) -> bool:
        return any(
            taken.count(length) < histogram[length] for length in lengths[: bisect_left(lengths, rest + 1)]
        )

    extend(room, room, ())
    return [filling for _, filling in found] or [()], steps


def fewest_possible(histogram: dict[int, int], capacity: int) -> int:
    """A lower bound: what is above a small size ``k`` needs its bins, whatever is below ``k`` fills up.

    Lengths that leave room for less than ``k`` are alone; others of more than half a bin have one each; the
    rest, from ``k`` on, needs what room those leave and bins beyond.
    """
    best = -(-sum(length * count for length, count in histogram.items()) // capacity)
    for k in {length for length in histogram if 2 * length <= capacity}:
        alone = sum(count for length, count in histogram.items() if length > capacity - k)
        halves = {n: c for n, c in histogram.items() if 2 * n > capacity and n <= capacity - k}
        small = sum(n * c for n, c in histogram.items() if k <= n and 2 * n <= capacity)
        room = sum((capacity - length) * count for length, count in halves.items())
        best = max(best, alone + sum(halves.values()) + max(0, -(-(small - room) // capacity)))
    return max(best, sum(count for length, count in histogram.items() if 2 * length > capacity))


def bin_completion(histogram: dict[int, int], capacity: int = CAPACITY) -> Packing:
    """Bins as (how often, lengths), as few as the bounded search finds.

    The first dive takes the best filling of every bin and always ends. Then each bin of each dive, the first one
    too, gets its next filling with a new dive from there: dives with fewer such changes come first.
    """
    total = sum(length * count for length, count in histogram.items())
    bound = fewest_possible(histogram, capacity)
    incumbent = best_fit(histogram, capacity)
    fewest = sum(bins for bins, _ in incumbent)
    steps, is_first = 0, True
    # A dive to change: its bins, how many of them stay, and the number of the next one's filling.
    waiting: deque[tuple[Packing, int, int]] = deque([([], 0, 0)])
    while waiting and fewest > bound and steps <= ALL_STEPS:
        earlier, n_stay, nth = waiting.popleft()
        done = earlier[:n_stay]
        left = dict(histogram)
        for times, filling in done:
            take(left, times, filling)
        bins = sum(times for times, _ in done)
        waste = sum(times * (capacity - sum(filling)) for times, filling in done)
        changes = []
        # To be better, a solution may waste no more than this in all its bins.
        allowed = (fewest - 1) * capacity - total
        while left and waste <= allowed and (is_first or steps <= ALL_STEPS):
            largest = max(left)
            rest = dict(left)
            rest[largest] -= 1
            lengths = sorted(length for length, count in rest.items() if count)
            choices, taken = fillings(rest, lengths, capacity - largest, nth + 1)
            steps += 0 if is_first else taken
            if nth >= len(choices):
                break
            changes.append((len(done), nth + 1))
            filling = (largest, *choices[nth])
            need = Counter(filling)
            times = min(left[length] // count for length, count in need.items())
            take(left, times, filling)
            done, bins, waste = [*done, (times, filling)], bins + times, waste + times * (capacity - sum(filling))
            nth = 0
        if not left and bins < fewest:
            incumbent, fewest = done, bins
        waiting.extend((done, place, number) for place, number in changes)
        is_first = False
    return incumbent


def take(left: dict[int, int], times: int, filling: Filling) -> None:
    for length in filling:
        left[length] -= times
        if not left[length]:
            del left[length]


def places(packing: Packing) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: the first piece number, the first sequence and the offset of each run of equal places."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    placed: Counter[int] = Counter()
    sequence = 0
    for bins, filling in packing:
        for length, offset in zip(filling, accumulate(filling, initial=0)):
            runs.setdefault(length, []).append((placed[length], sequence, offset))
            placed[length] += bins
        sequence += bins
    return {length: tuple(np.array(column) for column in zip(*rows)) for length, rows in runs.items()}


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id: str = "doc_id",
    text: str = "text",
    files: int | None = None,
) -> DataFrame:
    """One row per piece, with its ``sequence_id`` and its ``offset`` in the sequence."""
    cut = stored(pieces(texts_of(docs, id, text), tokenizer, capacity, end_id), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    per_task = stored(per_task, "pieces_per_task", files)
    counted = per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    where = places(bin_completion({row.length: row.n for row in counted}, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select(
        "length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("first")
    )
    numbered = cut.join(first, ["length", "task"]).withColumn("number", F.col("first") + F.col("number"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["sequence_id"], frame["offset"] = 0, 0
            for length, part in frame.groupby("length"):
                starts, sequences, offsets = where[length]
                run = np.searchsorted(starts, part["number"].to_numpy(), side="right") - 1
                frame.loc[part.index, "sequence_id"] = sequences[run] + part["number"] - starts[run]
                frame.loc[part.index, "offset"] = offsets[run]
            yield frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    fields = "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "number")
    return mapped(numbered.select(*columns), place, schema_of(cut, fields))
