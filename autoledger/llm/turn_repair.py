"""Structure repair of conversations by a dynamic program over their rows, streamed in the order of turns.

Rows are dealt by conversation and sorted by turn; one ``mapInPandas`` runs through the sorted rows and carries the state of
the program from one Arrow batch to the next, so memory does not follow the length of a conversation.

A row can be kept, get the role user or assistant, or be deleted, and rows of either role can be inserted anywhere, such that
the initials of the roles are ``(s?(ua)+)?`` in the end. The program knows four states: nothing yet, after the system row,
after a user row, after an assistant row. For each it carries the least cost of the edits so far, the place of their
initials among those of the other states in ASCII order, and the running SHA-256 of the repaired rows. A step takes
the edits of some state, up to two insertions and one edit of the row. Edits that end with a row's edit are never the
beginning of one another, so which is less is decided by the states' order and else by the step, and no string is ever
compared. Costs count from the least one, so steps repeat and are remembered.

Which step led to each state takes four bytes a row. These are kept in memory up to ``SPILL_BYTES`` and in a nameless file
of the task beyond, and read from the end to spell the edits.

Cases: a null role or text is one space, a null turn comes first and counts in no gap; equal turns go by role and text;
the initial of a role is its first character, and an empty role cannot be kept; a null conversation is a conversation; rows
that are marked as absent only name their conversation, which then may have no rows: zeros, no edits and the hash of
nothing; an empty table has no result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, ship

# What counts as white space, and how a whole text ends.
WHITE_SPACE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after one more row where only users and assistants may follow, and the roles of these states.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
FINAL = (NOTHING, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
WHOLE, MUST_GO, SHORT = range(3)
# Edits of one row, each after up to two insertions.
STEPS = tuple("I" * inserted + edit for inserted, edit in product(range(3), "DKR"))
SPILL_BYTES = 16_000_000
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = ("conv_id", *COUNTS, "audit", "repaired_sha256")

Costs = tuple[int | None, ...]
Ranks = tuple[int, ...]


@lru_cache(maxsize=64)
def steps_of(initial: str, kind: int) -> tuple[tuple[int, int, int, int], ...]:
    """Possible steps over a row: state before, state after, cost, number of the step."""
    found = []
    for before, (number, step) in product(range(4), enumerate(STEPS)):
        state, cost = before, 0
        for _ in range(step.count("I")):
            state, cost = FOLLOWING[state], cost + INSERT
        edit = step[-1]
        if edit == "D":
            found.append((before, state, cost + DELETE, number))
            continue
        if kind == MUST_GO:
            continue
        cost += CUT_SHORT if kind == SHORT else 0
        if edit == "R":
            found.append((before, FOLLOWING[state], cost + REROLE, number))
        elif initial == "s" and state == NOTHING:
            found.append((before, SYSTEM, cost, number))
        elif initial == ROLES[FOLLOWING[state]][0]:
            found.append((before, FOLLOWING[state], cost, number))
    return tuple(found)


@lru_cache(maxsize=100_000)
def stepped(costs: Costs, ranks: Ranks, initial: str, kind: int) -> tuple[int, Costs, Ranks, bytes]:
    """The state after a row: what all costs have grown by, the costs beyond that, the order of the edits, and for each state
    the step that leads to it, as nine times the state before plus the step's number."""
    best: dict[int, tuple[int, int, str, int, int]] = {}
    for before, after, cost, number in steps_of(initial, kind):
        if costs[before] is None:
            continue
        one = (costs[before] + cost, ranks[before], STEPS[number], before, number)
        if after not in best or one < best[after]:
            best[after] = one
    grown = min(one[0] for one in best.values())
    in_order = sorted(best, key=lambda state: best[state][1:3])
    return (
        grown,
        tuple(best[state][0] - grown if state in best else None for state in range(4)),
        tuple(in_order.index(state) if state in best else 0 for state in range(4)),
        bytes(9 * best[state][3] + best[state][4] if state in best else 255 for state in range(4)),
    )


class Backpointers:
    """Four bytes a row, in memory or in a file of the task's own, read from the end."""

    def __init__(self, most: int = SPILL_BYTES) -> None:
        self.held = bytearray()
        self.most = most
        self.file = None

    def add(self, pointers: bytes) -> None:
        self.held += pointers
        if len(self.held) >= self.most:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held.clear()

    def backwards(self) -> Iterator[bytes]:
        """The pointers in parts, the last first."""
        yield bytes(self.held)
        if self.file is not None:
            end = self.file.tell()
            while end:
                size = min(self.most - self.most % 4 or 4, end)
                self.file.seek(end - size)
                yield self.file.read(size)
                end -= size

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Repair:
    """One conversation, row by row."""

    def __init__(self, conv_id: str | None) -> None:
        self.conv_id = conv_id
        self.costs: Costs = (0, None, None, None)
        self.ranks: Ranks = (0, 0, 0, 0)
        self.cost = 0
        self.hashes = [hashlib.sha256(), None, None, None]
        self.pointers = Backpointers()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.initial: str | None = None
        self.turns, self.first_turn, self.turn = 0, None, None

    def add(self, turn: str | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns, self.turn = self.turns + 1, turn
        if fault is not None:
            self.faults[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = initial

        kind = WHOLE if fault is None else SHORT if fault == "truncated" else MUST_GO
        known = initial if initial in ("s", "u", "a") else ""
        grown, self.costs, self.ranks, pointers = stepped(self.costs, self.ranks, known, kind)
        self.cost += grown
        self.pointers.add(pointers)
        data = text.encode()
        self.hashes = [
            None if pointer == 255 else self.extended(pointer // 9, STEPS[pointer % 9], role, data) for pointer in pointers
        ]

    def extended(self, before: int, step: str, role: str, text: bytes):
        """The hash of the repaired rows of one state, a step on."""
        found = self.hashes[before].copy()
        state = before
        for edit in step:
            if edit == "D":
                continue
            after = SYSTEM if edit == "K" and state == NOTHING and role[:1] == "s" else FOLLOWING[state]
            name = role if edit == "K" else ROLES[after]
            found.update((b"" if state == NOTHING else b"\n") + name.encode() + b":" + (b"" if edit == "I" else text))
            state = after
        return found

    def result(self) -> tuple:
        """Closes the conversation: the cheapest state after the insertions it needs to end well."""
        ends = []
        for before, n_inserted in product(range(4), range(3)):
            if self.costs[before] is None:
                continue
            state = before
            for _ in range(n_inserted):
                state = FOLLOWING[state]
            if state in FINAL:
                ends.append((self.costs[before] + INSERT * n_inserted, self.ranks[before], n_inserted, before))
        cost, _, n_inserted, state = min(ends)
        digest = self.extended(state, "I" * n_inserted, "", b"").hexdigest()
        audit = ["I" * n_inserted]
        for part in self.pointers.backwards():
            spelled = []
            for place in range(len(part) - 4, -1, -4):
                pointer = part[place + state]
                spelled.append(STEPS[pointer % 9])
                state = pointer // 9
            audit.append("".join(reversed(spelled)))
        self.pointers.close()
        gaps = int(self.turn) - int(self.first_turn) + 1 - self.turns if self.turns else 0
        counts = (self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal)
        return (self.conv_id, gaps, *counts, self.cost + cost, "".join(reversed(audit)), digest)


def faults(role: Column, text: Column, earlier: Column) -> Column:
    """The first fault of a row: ``blank``, ``duplicate`` or ``truncated``."""
    trimmed = F.rtrim(text, F.lit(WHITE_SPACE))
    return (
        F.when(trimmed == "", "blank")
        .when(earlier, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS), "truncated")
    )


def repaired(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """Per conversation its faults, and the cost, the initials and the result of its cheapest repair.

    ``present`` is false for rows that only name their conversation.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = conversations.select(
        column(conv_id).cast("string").alias("conv_id"),
        column(turn).cast("long").alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(text).cast("string"), F.lit(" ")).alias("text"),
        here.alias("present"),
    )
    # One shuffle: rows dealt by conversation are dealt by conversation, role and text as well.
    by_conversation = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = by_conversation.withColumn(
        "fault", faults(F.col("role"), F.col("text"), F.row_number().over(same) > 1)
    )
    in_order = marked.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").select(
        "conv_id", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "present"
    )
    ship(conversations.sparkSession)
    fields = [f"{name} {'long' if name in COUNTS else 'string'}" for name in RESULT]
    result = in_order.mapInPandas(repairs, ", ".join(fields))
    kind = conversations.schema[conv_id].dataType
    return result.withColumn("conv_id", F.col("conv_id").cast(kind)).withColumnRenamed("conv_id", conv_id)


def repairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs through rows in order; a conversation may go on in the next batch."""
    current: Repair | None = None
    for frame in frames:
        done = []
        for conv_id, turn, role, text, fault, present in zip(*(frame[name] for name in frame.columns)):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.result())
                current = Repair(conv_id)
            if present:
                current.add(turn, role, text, fault)
        if done:
            yield pd.DataFrame(done, columns=RESULT)
    if current is not None:
        yield pd.DataFrame([current.result()], columns=RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn: about one in four.

    ``present`` is false for those dropped. Others lose their text, its sentence ends or their role, or stand twice.
    """
    spelled = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    damage = F.crc32(F.concat_ws(":", *spelled)) % 20
    text, role = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("text", "role"))
    copies = F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (damage != 0).alias("present"),
        copies.alias("copy"),
    ).drop("copy")
