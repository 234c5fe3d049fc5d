"""Conversation repair against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

from pyspark.sql import functions as F

from autoledger.llm import queries, turn_repair

from .conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, audit string, fault string"
LEGAL = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"
# The search calls itself for each row.
sys.setrecursionlimit(20_000)


def in_order(rows):
    return sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))


def faults_of(rows):
    seen, found = set(), []
    for _, role, text in rows:
        solid = text.strip(SPACE)
        blank, again = not solid, (role, text) in seen
        found.append("blank" if blank else "duplicate" if again else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def cheapest(rows):
    """Least cost and then least audit over all edits, by the definition: (cost, audit, repaired rows)."""
    faults = faults_of(rows)

    @lru_cache(maxsize=None)
    def best(place: int, made: str, inserted: int):
        options = []
        if place == len(rows) and LEGAL.fullmatch(made):
            options.append((0, "", ()))
        if inserted < 2:
            for role in ("user", "assistant"):
                rest = best(place, shortened(made + role[0]), inserted + 1)
                if rest:
                    options.append((3 + rest[0], "I" + rest[1], (f"{role}:", *rest[2])))
        if place < len(rows):
            _, role, text = rows[place]
            fault = faults[place]
            rest = best(place + 1, made, 0)
            if rest:
                options.append((4 + rest[0], "D" + rest[1], rest[2]))
            if fault in (None, "truncated"):
                extra = 3 * (fault == "truncated")
                for new, cost, edit in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if not new:
                        continue
                    rest = best(place + 1, shortened(made + new[0]), 0)
                    if rest:
                        options.append((cost + extra + rest[0], edit + rest[1], (f"{new}:{text}", *rest[2])))
        return min(options, default=None)

    def shortened(made: str) -> str:
        """Initials that no edits can mend are one dead end; legal ones are told apart by how they may go on."""
        if LEGAL.fullmatch(made):
            return "ua" if made else ""
        if made == "s" or LEGAL.fullmatch(made + "a"):
            return made if made == "s" else "u"
        return "!"

    return best(0, "", 0)


def expected(rows):
    rows = in_order(rows)
    faults = faults_of(rows)
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, repaired = cheapest(rows)
    digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
    counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest)


def by_conversation(rows):
    held = {}
    for conv_id, turn, role, text in rows:
        held.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    return held


def checked(found, held):
    got = {row.conv_id: tuple(row)[1:] for row in found.collect()}
    assert set(got) == set(held)
    for conv_id, rows in held.items():
        assert got[conv_id] == expected(rows), (conv_id, rows)


def damaged(rows):
    """The damage by its definition; conversations without rows stay."""
    held = {}
    for conv_id, turn, role, text in rows:
        kept = held.setdefault(conv_id, [])
        role, text = (" " if one is None else one for one in (role, text))
        spelled = ":".join(" " if one is None else str(one) for one in (conv_id, turn))
        damage = zlib.crc32(spelled.encode()) % 20
        if damage == 0:
            continue
        if damage == 1:
            text = ""
        if damage == 2:
            text = re.sub("[.!?]", "", text)
        kept += [(turn, "user" if damage == 4 else role, text)] * (2 if damage == 3 else 1)
    return held


def test_op12_on_the_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    held = damaged(map(tuple, table.select("conv_id", "turn", "role", "text").collect()))
    checked(queries.op12_conversation_repair(spark, SMALL), held)


def test_random_conversations(spark):
    draw = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "S"]
    texts = ["one.", "two?", "three", "", " \t\n", None, "one. ", "four!\n"]
    rows = [
        (
            draw.choice([None, *range(300)]),
            draw.choice([None, -3, *range(9), 1 << 60, (1 << 60) + 1]),
            draw.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0],
            draw.choices(texts, [4, 4, 2, 1, 1, 1, 1, 1])[0],
        )
        for _ in range(1500)
    ]
    table = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    checked(turn_repair.repaired(table), by_conversation(rows))
    checked(turn_repair.repaired(turn_repair.damaged(table), present=F.col("present")), damaged(rows))


def test_empty_table_and_absent_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repaired(empty).count() == 0
    one = spark.createDataFrame([(5, 1, "user", "text.", "x", "y"), (None, None, None, None, None, None)], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    rows = turn_repair.repaired(one, present=F.lit(False)).collect()
    assert sorted(map(tuple, rows), key=repr) == [(5, 0, 0, 0, 0, 0, 0, "", nothing), (None, 0, 0, 0, 0, 0, 0, "", nothing)]


def giant(n: int, seed: int):
    draw = random.Random(seed)
    return [(turn, draw.choice(["user", "assistant", "system"]), f"text {turn}" + draw.choice([".", ""])) for turn in range(n)]


def test_state_goes_on_over_batches_and_pointers_are_spilled(spark, settings, monkeypatch):
    rows = giant(700, 9)
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="50")
    table = spark.createDataFrame([(1, *row, "x", "y") for row in rows], SCHEMA)
    checked(turn_repair.repaired(table), {1: rows})

    opened = []
    real = turn_repair.tempfile.TemporaryFile
    monkeypatch.setattr(turn_repair.tempfile, "TemporaryFile", lambda: opened.append(real()) or opened[-1])
    for most in (4, 12, 1000):
        repair = turn_repair.Repair("1")
        repair.pointers = turn_repair.Backpointers(most)
        for (turn, role, text), fault in zip(rows, faults_of(rows)):
            repair.add(str(turn), role, text, fault)
        assert repair.result()[1:] == expected(rows)
    assert len(opened) == 3 and all(file.closed for file in opened)


def test_a_common_text_in_one_long_conversation(spark):
    rows = [(turn, "user" if turn % 2 == 0 else "assistant", "the same." if turn % 3 else f"{turn}.") for turn in range(600)]
    table = spark.createDataFrame([(1, *row, "x", "y") for row in rows], SCHEMA)
    checked(turn_repair.repaired(table), {1: rows})
