"""Expressions on the edge values that decide their meaning."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from autoledger import functions as A


def applied(spark, function, values):
    rows = [(position, value) for position, value in enumerate(values)]
    table = spark.createDataFrame(rows, "position int, value string")
    result = table.select("position", function(F.col("value")).alias("result")).collect()
    return [row.result for row in sorted(result, key=lambda row: row.position)]


CASES = {
    "dialable": (
        A.dialable,
        ["+91-98765-43210", "+1-555-010-9999", "555-010-9999", "91-+5-5", "+44", None],
        ["+91 9876543210", "+1 5550109999", "5550109999", "91+55", "+44", None],
    ),
    "without_hyphens": (A.without_hyphens, ["US-001-234", "--", "x", "", None], ["US001234", "", "x", "", None]),
    "serial_number": (
        A.serial_number,
        ["US-001-234", "US001234", "AB12", None],
        ["01-234", "001234", "AB12", None],
    ),
    "country_code": (A.country_code, ["US-001", "U", None], ["US", "U", None]),
    "country_code_3": (lambda c: A.country_code(c, 3), ["US-001", "US001"], ["US-", "US0"]),
    "upper_trimmed": (A.upper_trimmed, ["  card ", "\tcard", "", None], ["CARD", "\tCARD", "", None]),
    "or_not_available": (A.or_not_available, [None, "", "x"], ["Not Available", "", "x"]),
    "initcap": (F.initcap, ["TATA motors-ltd", None], ["Tata Motors-ltd", None]),
    "money": (
        A.money,
        ["10.005", " 12.5 ", "1e3", "1,200.50", "abc", "", "123456789.99", "-5.00", None],
        [Decimal("10.01"), Decimal("12.50"), Decimal("1000.00"), None, None, None, None, Decimal("-5.00"), None],
    ),
    "whole_number": (
        A.whole_number,
        [" 7 ", "7.9", "-3", "n/a", "99999999999", None],
        [7, None, -3, None, None, None],
    ),
    "iso_day": (
        A.iso_day,
        ["2024-02-03", "2024-1-5", "2024-02-30", "2024-02-03 10:00:00", " 2024-02-03", "bad", None],
        [datetime.date(2024, 2, 3), None, None, None, None, None, None],
    ),
    "overdue_flag": (lambda c: A.overdue_flag(c.cast("int")), ["5", "0", "-1", None], ["Y", "N", "N", "N"]),
    "payment_category": (
        A.payment_category,
        ["CARD", "CASH", "FINANCE", "LEASE", "WIRE", "card", None],
        ["CARD", "CASH", "FINANCE", "LEASE", "OTHER", "OTHER", "OTHER"],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_expression(spark, name):
    function, values, expected = CASES[name]
    assert applied(spark, function, values) == expected


def test_conversions_leave_ansi_mode_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert applied(spark, A.money, ["junk"]) == [None]


def test_iso_day_is_try_to_date_with_the_pattern(spark):
    import random

    rng = random.Random(5)
    odd = """2024-01-05T 0000-01-01 0001-01-01 9999-12-31 12024-01-01 +12024-01-01 +2024-01-01 -2024-01-01
    2024-13-01 2024-00-10 2024-01-00 1900-02-29 2000-02-29 24-01-05 2024/01/05 20240105""".split()
    odd += ["2024-01-05\n", "2024-01-05 ", "\t2024-01-05", "٢٠٢٤-01-05", "", "+", "-", "2024-01-05+00:00"]
    days = [f"{rng.randrange(1, 9999):04}-{rng.randrange(15):02}-{rng.randrange(34):02}" for _ in range(500)]
    noise = ["".join(rng.choice("0129-+ :T") for _ in range(10)) for _ in range(500)]
    table = spark.createDataFrame([(text,) for text in odd + days + noise], "value string")
    both = table.select(
        "value",
        A.iso_day(F.col("value")).cast("string").alias("ours"),
        F.try_to_date("value", "yyyy-MM-dd").cast("string").alias("theirs"),
    )
    assert both.filter("ours IS DISTINCT FROM theirs").collect() == []
    assert both.filter("ours IS NOT NULL").count() > 300
