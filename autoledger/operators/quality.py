"""Valid/rejected splits from an ordered list of rules.

A rule names a fault and the condition that shows it. ``passing`` and ``failing`` are complements over
nulls as well: a rule that compares a column comes after one that rejects the column's null, so a
comparison that yields null never decides a row. Negations are left to Catalyst, which turns them into
plain comparisons and pushes what the scan can use.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    reason: str
    broken: Column


def passing(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return rows.filter(reduce(and_, [~rule.broken for rule in rules]))


def failing(rows: DataFrame, rules: Sequence[Rule], otherwise: str) -> DataFrame:
    """Rows that break a rule, with the first broken rule's reason and the time of rejection."""
    reason = F.coalesce(
        *[F.when(rule.broken, F.lit(rule.reason)) for rule in rules],
        F.lit(otherwise),
    )
    return rows.filter(reduce(or_, [rule.broken for rule in rules])).withColumns(
        {"rejection_reason": reason, "rejected_at": F.current_timestamp()}
    )
