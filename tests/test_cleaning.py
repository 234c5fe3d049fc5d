"""Cleaning and the valid/rejected splits."""

from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from autoledger.operators import (
    clean_customers,
    rejected_payments,
    rejected_products,
    valid_payments,
    valid_products,
)
from autoledger.sources import CUSTOMER, PAYMENT, PRODUCT

from .conftest import as_set

VIN = "V" * 17


def feed_frame(spark, feed, rows):
    full = [tuple(row.get(name) for name in feed.schema.names) for row in rows]
    return spark.createDataFrame(full, feed.schema)


def payment(**values):
    good = {
        "transaction_id": "T1",
        "payment_date": "2024-01-05",
        "vin": f" {VIN.lower()} ",
        "amount_paid": "10.00",
        "payment_method": " card ",
    }
    return {**good, **values}


@pytest.fixture(scope="module")
def every_payment(spark):
    """All combinations of present, absent and odd values in the fields that rules look at."""
    options = {
        "transaction_id": ["T", None, ""],
        "payment_date": ["2024-01-05", None, "bad", ""],
        "vin": [VIN, f" {VIN} ", "short", VIN + "X", "", None],
        "amount_paid": ["1", "0", "-1", "abc", "0.004", "123456789.99", None],
        "_corrupt_rec": [None, "line"],
    }
    rows = [
        {**dict(zip(options, values)), "service_id": str(position)}
        for position, values in enumerate(product(*options.values()))
    ]
    return feed_frame(spark, PAYMENT, rows)


@pytest.mark.parametrize("reject_malformed", [False, True])
def test_each_payment_is_on_exactly_one_side(every_payment, reject_malformed):
    total = every_payment.count()
    valid = valid_payments(every_payment, reject_malformed).select("service_id")
    rejected = rejected_payments(every_payment, reject_malformed).select("service_id")
    assert valid.count() > 0 and rejected.count() > 0
    assert valid.count() + rejected.count() == total
    assert valid.intersect(rejected).count() == 0


def test_no_payment_is_rejected_without_a_known_reason(every_payment):
    reasons = {row[0] for row in rejected_payments(every_payment).select("rejection_reason").collect()}
    assert reasons == {
        "transaction_id is null",
        "payment_date is null",
        "VIN is null",
        "VIN length not 17",
        "amount_paid is null",
        "amount_paid must be > 0",
    }


def test_first_broken_rule_gives_the_reason(spark):
    rows = [
        payment(transaction_id=None, vin=None),
        payment(payment_date="x", amount_paid="abc"),
        payment(vin=None, amount_paid="-1"),
        payment(vin="short", amount_paid=None),
        payment(amount_paid=None),
        payment(amount_paid="0"),
    ]
    rows = [{**row, "service_id": str(position)} for position, row in enumerate(rows)]
    rejected = rejected_payments(feed_frame(spark, PAYMENT, rows))
    assert as_set(rejected, "service_id", "rejection_reason") == [
        ("0", "transaction_id is null"),
        ("1", "payment_date is null"),
        ("2", "VIN is null"),
        ("3", "VIN length not 17"),
        ("4", "amount_paid is null"),
        ("5", "amount_paid must be > 0"),
    ]


def test_payment_columns_and_types(spark):
    frame = feed_frame(spark, PAYMENT, [payment()])
    valid = valid_payments(frame)
    assert valid.columns == [
        *PAYMENT.schema.names, "is_overdue", "payment_category", "silver_ingest_ts"
    ]
    assert len(valid.columns) == 32
    assert len(rejected_payments(frame).columns) == 34
    types = dict(valid.dtypes)
    assert {types[name] for name in ("amount_paid", "total_cost", "parts_cost", "labour_cost")} == {
        "decimal(10,2)"
    }
    assert {types[name] for name in ("payment_date", "due_date", "service_due_date")} == {"date"}
    assert {types[name] for name in ("days_overdue", "mileage_at_service")} == {"int"}
    assert types["silver_ingest_ts"] == "timestamp"


@pytest.mark.parametrize("reject_malformed", [False, True])
def test_each_product_is_on_exactly_one_side(spark, reject_malformed):
    vins = [VIN, f" {VIN}", "short", "", None]
    rows = [{"vin": vin, "_corrupt_record": mark} for vin in vins for mark in (None, "line")]
    frame = feed_frame(spark, PRODUCT, rows)
    valid = valid_products(frame, reject_malformed).count()
    assert valid == (1 if reject_malformed else 2)
    assert valid + rejected_products(frame, reject_malformed).count() == len(rows)


def test_rejected_product_takes_three_characters_of_the_dealer_id(spark):
    rows = [{"vin": VIN, "dealer_id": "US-001-234"}, {"vin": "x", "dealer_id": "US-001-234"}]
    frame = feed_frame(spark, PRODUCT, rows)
    assert as_set(valid_products(frame), "country_code", "serial_number") == [("US", "001234")]
    assert as_set(rejected_products(frame), "country_code", "serial_number", "rejection_reason") == [
        ("US0", "001234", "VIN length is not 17 digits")
    ]
    assert len(valid_products(frame).columns) == 11
    assert len(rejected_products(frame).columns) == 13


def test_customer_serial_is_taken_before_hyphens_go(spark):
    row = {"dealer_id": "US-001-234", "customer_id": "C-1-2", "phone_home": "+91-98765-43210"}
    cleaned = clean_customers(feed_frame(spark, CUSTOMER, [row]))
    assert len(cleaned.columns) == 30
    result = cleaned.select(
        "dealer_id", "serial_number", "country_code", "customer_id", "phone_home", "company_name"
    ).first()
    assert tuple(result) == ("US001234", "01-234", "US", "C12", "+91 9876543210", "Not Available")


def test_cleaning_works_on_ansi_mode_junk(spark):
    frame = feed_frame(spark, PAYMENT, [payment(days_overdue="x", service_date="31/12/2024")])
    row = valid_payments(frame).select("days_overdue", "service_date", F.col("is_overdue")).first()
    assert tuple(row) == (None, None, "N")
