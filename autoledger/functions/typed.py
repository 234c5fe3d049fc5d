"""Typing of text fields and the flags derived from typed fields.

Feeds hold junk. Under ANSI mode, Spark's default, a plain cast would end the whole job at the first bad
value, so each conversion yields null instead and leaves ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results must agree on.
MONEY_TYPE = "decimal(10,2)"
PAYMENT_CATEGORIES = ("CARD", "CASH", "FINANCE", "LEASE")
OTHER_CATEGORY = "OTHER"


def money(text: Column) -> Column:
    return text.try_cast(MONEY_TYPE)


def whole_number(text: Column) -> Column:
    return text.try_cast("int")


def iso_day(text: Column) -> Column:
    """The day of a text in the form ``yyyy-MM-dd``, to the letter, else null.

    What ``try_to_date`` with that pattern gives, in a fraction of its time: the cast also reads looser
    forms, so a text counts only if its day is written back as the same text.
    """
    day = text.try_cast("date")
    return F.when(day.cast("string") == text, day)


def overdue_flag(days: Column) -> Column:
    """``Y`` for a positive number of days, ``N`` for anything else, null included."""
    return F.when(days > 0, F.lit("Y")).otherwise(F.lit("N"))


def payment_category(method: Column) -> Column:
    """The method itself where it is a known category, else ``OTHER``; expects upper-case text."""
    return F.when(method.isin(*PAYMENT_CATEGORIES), method).otherwise(F.lit(OTHER_CATEGORY))
