"""The three feeds, derived from the test tables.

The test tables hold no vehicles, so customers, parts and orders are dressed up as the customer, product and
payment feed, faults included. Each field is one SQL expression that Spark and DuckDB read alike; the work
under test starts after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from autoledger.session import small_methods
from autoledger.sources import CUSTOMER, PAYMENT, PRODUCT, Feed


def padded(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS STRING), {width}, '0')"


def dealer(key: str) -> str:
    country = f"CASE {key} % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' WHEN 2 THEN 'DE' ELSE 'JP' END"
    return f"{country} || '-' || {padded(f'{key} % 50', 3)} || '-' || {padded(f'{key} % 7', 3)}"


def text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def day(year: int, key: str) -> str:
    return f"'{year}-' || {padded(f'1 + {key} % 12', 2)} || '-' || {padded(f'1 + {key} % 28', 2)}"


_C = "c_custkey"
CUSTOMER_FEED = {
    "customer_id": f"'C-' || {padded(_C, 12)}",
    "first_name": "c_name",
    "last_name": f"'Family ' || {text(f'{_C} % 100')}",
    "date_of_birth": day(1970, _C),
    "national_id": f"'ID-' || {padded(_C, 12)} || '-' || {text('c_nationkey')}",
    "email": f"'c' || {text(_C)} || '@mail.example'",
    "phone_mobile": f"'+' || {text('10 + c_nationkey')} || '-' || {padded(f'{_C} % 1000', 3)}"
    f" || '-' || {padded(_C, 12)}",
    "phone_home": f"CASE {_C} % 5 WHEN 0 THEN NULL WHEN 1 THEN '+44' WHEN 2 THEN '91-+5-5'"
    f" WHEN 3 THEN '555-010-' || {padded(f'{_C} % 10000', 4)}"
    f" ELSE '+1-555-010-' || {padded(f'{_C} % 10000', 4)} END",
    "address_line1": f"{text(_C)} || ' Main Street'",
    "address_line2": f"CASE WHEN {_C} % 2 = 1 THEN 'Unit ' || {text(_C)} END",
    "city": f"'City ' || {text(f'{_C} % 100')}",
    "state": f"'S' || {text(f'{_C} % 20')}",
    "zip_code": padded(f"{_C} % 100000", 5),
    "country": text("c_nationkey"),
    "dealer_id": dealer(_C),
    "customer_type": f"CASE WHEN {_C} % 4 = 0 THEN c_mktsegment || ' fleet-BUYER' ELSE c_mktsegment END",
    "company_name": f"CASE WHEN {_C} % 3 <> 0 THEN 'Co ' || {text(_C)} END",
    "account_status": f"CASE WHEN {_C} % 9 = 0 THEN 'closed' ELSE 'active' END",
    "vin": f"'VIN' || {padded(_C, 14)}",
    "purchase_date": day(2020, _C),
    "ownership_type": f"CASE WHEN {_C} % 2 = 0 THEN 'owned' ELSE 'leased' END",
    "credit_score": text(f"300 + {_C} % 550"),
    "payment_method": f"CASE WHEN {_C} % 6 = 0 THEN 'invoice' ELSE 'card' END",
    "currency": f"CASE WHEN {_C} % 2 = 0 THEN 'USD' ELSE 'EUR' END",
    "system_id": f"'CRM' || {text(f'{_C} % 3')}",
    "created_date": day(2021, _C),
    "last_updated": day(2023, _C),
}

_P = "p_partkey"
PRODUCT_FEED = {
    "dealer_id": dealer(_P),
    "sgrp_id": "p_brand",
    "manufacturer": "upper(p_name)",
    "legal_name": "replace(p_name, ' ', '-')",
    "email": f"'p' || {text(_P)} || '@dealer.example'",
    "system_id": f"'S' || {text(_P)}",
    "vin": f"CASE {_P} % 20 WHEN 0 THEN NULL WHEN 1 THEN 'BAD' || {text(_P)}"
    f" ELSE 'VIN' || {padded(_P, 14)} END",
}

_O = "o_orderkey"
_ORDERED = "CAST(CAST(o_orderdate AS DATE) AS STRING)"


def _cost(divisor: int) -> str:
    return f"{text(f'{_O} % {divisor}')} || '.' || {padded(f'{_O} % 100', 2)}"


PAYMENT_FEED = {
    "transaction_id": f"CASE WHEN {_O} % 50 <> 0 THEN 'T' || {text(_O)} END",
    "customer_id": f"'C-' || {padded('o_custkey', 12)}",
    "vin": f"CASE {_O} % 50 WHEN 1 THEN NULL WHEN 2 THEN 'vin1'"
    f" ELSE '  vin' || {padded('o_custkey', 14)} || ' ' END",
    "dealer_id": dealer("o_custkey"),
    "card_type": f"CASE {_O} % 3 WHEN 0 THEN ' visa' WHEN 1 THEN 'Master ' END",
    "card_last4": padded(f"{_O} % 10000", 4),
    "amount_paid": f"CASE {_O} % 50 WHEN 3 THEN 'abc' WHEN 4 THEN '-5.00'"
    " ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS STRING) END",
    "currency": f"CASE {_O} % 3 WHEN 0 THEN ' usd ' WHEN 1 THEN 'Eur' ELSE 'INR' END",
    "payment_date": f"CASE WHEN {_O} % 50 = 5 THEN 'bad' ELSE {_ORDERED} END",
    "payment_status": f"CASE {_O} % 4 WHEN 0 THEN ' paid' WHEN 1 THEN 'Pending ' WHEN 2 THEN 'FAILED' END",
    "payment_method": f"CASE {_O} % 5 WHEN 0 THEN ' card ' WHEN 1 THEN 'Cash' WHEN 2 THEN 'finance'"
    " WHEN 3 THEN 'LEASE' ELSE 'wire' END",
    "service_id": f"'SV-' || {text(_O)}",
    "service_type": f"CASE {_O} % 3 WHEN 0 THEN ' oil change' WHEN 1 THEN 'Inspection ' ELSE 'repair' END",
    "service_date": f"CASE WHEN {_O} % 50 = 7 THEN '2024-02-30' ELSE {_ORDERED} END",
    "service_due_date": day(2024, _O),
    "mileage_at_service": f"CASE WHEN {_O} % 50 = 8 THEN 'n/a' ELSE {text(f'{_O} * 13 % 200000')} END",
    "service_charge": f"CASE WHEN {_O} % 50 = 9 THEN {text(f'{_O} % 100')} || '.005' ELSE {_cost(1000)} END",
    "parts_cost": _cost(500),
    "labour_cost": f"CASE WHEN {_O} % 50 = 10 THEN '123456789.99' ELSE {_cost(300)} END",
    "total_cost": f"CASE WHEN {_O} % 50 = 11 THEN '1,200.50' ELSE {_cost(2000)} END",
    "service_status": f"CASE WHEN {_O} % 2 = 0 THEN ' done' ELSE 'Open ' END",
    "technician_id": f"'TECH-' || {text(f'{_O} % 97')}",
    "outstanding_balance": f"CASE WHEN {_O} % 3 = 0 THEN NULL ELSE {_cost(700)} END",
    "due_date": f"CASE WHEN {_O} % 4 = 0 THEN NULL ELSE {day(2025, _O)} END",
    "days_overdue": f"CASE WHEN {_O} % 50 <> 6 THEN {text(f'{_O} % 7 - 3')} END",
    "last_payment_date": f"CASE WHEN {_O} % 3 = 1 THEN {day(2023, _O)} END",
    "finance_plan_id": f"CASE WHEN {_O} % 5 = 2 THEN 'FP' || {text(f'{_O} % 11')} END",
    "system_id": f"'SYS' || {text(f'{_O} % 5')}",
}

# feed -> (test table, key of the test table, field expressions)
DERIVED = {
    "customer": ("customer", _C, CUSTOMER_FEED),
    "product": ("part", _P, PRODUCT_FEED),
    "payment": ("orders", _O, PAYMENT_FEED),
}
FEED_OF = {"customer": CUSTOMER, "product": PRODUCT, "payment": PAYMENT}

# Every 40th line gets a field too many, every 40th loses all but its first three.
LONG_LINE, SHORT_LINE, LINE_CYCLE = 7, 9, 40
EXTRA_FIELD = "extra"
SHORT_LINE_FIELDS = 3


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, least: int = 1) -> tuple[DataFrame, int]:
    """Rows dealt evenly over tasks, one for each core, split and ``least``, and the number of tasks.

    A line of a feed is some twenty times the size of its row in the test table, and a Parquet file is read by no more
    tasks than it has row groups; so the rows move, and the lines are made where they are written.
    """
    tasks = max(least, rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks), tasks


def feed_rows(
    spark: SparkSession, sf_dir: str, name: str, keep: tuple[str, ...] = (), deal: bool = False
) -> DataFrame:
    """The feed as a batch of bronze rows: its fields, an empty capture column, test table columns to keep."""
    table, _, fields = DERIVED[name]
    feed: Feed = FEED_OF[name]
    rows = source_table(spark, sf_dir, table)
    return (dealt(rows)[0] if deal else rows).selectExpr(
        *[f"{fields[column]} AS {column}" for column in feed.fields],
        f"CAST(NULL AS STRING) AS {feed.capture}",
        *keep,
    )


def joined_fields(name: str, upto: int | None = None) -> str:
    """SQL for a line of the feed: fields in order, tabs between, nulls as empty fields."""
    _, _, fields = DERIVED[name]
    columns = FEED_OF[name].fields[:upto]
    return " || '\t' || ".join(f"coalesce({fields[column]}, '')" for column in columns)


def line_sql(name: str, with_malformed: bool) -> str:
    whole = joined_fields(name)
    if not with_malformed:
        return whole
    _, key, _ = DERIVED[name]
    return (
        f"CASE {key} % {LINE_CYCLE} WHEN {LONG_LINE} THEN {whole} || '\t{EXTRA_FIELD}'"
        f" WHEN {SHORT_LINE} THEN {joined_fields(name, SHORT_LINE_FIELDS)} ELSE {whole} END"
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as text files. The expression of a line makes a function too long to be compiled unless it is divided."""
    with small_methods(lines.sparkSession):
        lines.write.text(path)


def write_feed_files(
    spark: SparkSession, sf_dir: str, name: str, path: str, files: int = 3, with_malformed: bool = False
) -> int:
    """The feed as text files, at least ``files``; returns how many tasks write one."""
    table, _, _ = DERIVED[name]
    rows, tasks = dealt(source_table(spark, sf_dir, table), files)
    write_lines(rows.selectExpr(f"{line_sql(name, with_malformed)} AS value"), path)
    return tasks
