"""For each acceptance query the SQL that DuckDB runs on the same test tables.

The feeds' field expressions are shared with the Spark side; everything after them is written again here.
Days, amounts and nullable numbers are compared as text, because engines hand them to Python in different
types.
"""

from __future__ import annotations

from .feeds import (
    DERIVED,
    EXTRA_FIELD,
    FEED_OF,
    LINE_CYCLE,
    LONG_LINE,
    SHORT_LINE,
    SHORT_LINE_FIELDS,
    joined_fields,
)

CUSTOMER_COLUMNS = FEED_OF["customer"].fields
PRODUCT_COLUMNS = FEED_OF["product"].fields
PAYMENT_COLUMNS = FEED_OF["payment"].fields


def feed(name: str, capture: str | None = None) -> str:
    """The raw feed as a subquery body; with ``capture`` malformed lines are in it as the reader sees them."""
    table, key, fields = DERIVED[name]
    shown = []
    for position, column in enumerate(FEED_OF[name].fields):
        value = fields[column]
        if capture is not None and position >= SHORT_LINE_FIELDS:
            value = f"CASE WHEN {key} % {LINE_CYCLE} <> {SHORT_LINE} THEN {value} END"
        shown.append(f"{value} AS {column}")
    if capture is not None:
        shown.append(
            f"CASE {key} % {LINE_CYCLE}"
            f" WHEN {LONG_LINE} THEN {joined_fields(name)} || '\t{EXTRA_FIELD}'"
            f" WHEN {SHORT_LINE} THEN {joined_fields(name, SHORT_LINE_FIELDS)} END AS {capture}"
        )
    return f"SELECT {', '.join(shown)} FROM {table}"


def initcap(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '),"
        " lambda word: upper(word[1]) || lower(word[2:])), ' ')"
    )


def phone(column: str) -> str:
    return rf"replace(regexp_replace({column}, '^(\+\d+)-', '\1 '), '-', '')"


def amount(column: str) -> str:
    return f"TRY_CAST({column} AS DECIMAL(10,2))"


def day(column: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({column}, '\d{{4}}-\d{{2}}-\d{{2}}')"
        f" THEN TRY_CAST({column} AS DATE) END"
    )


def select_list(columns, changed: dict[str, str]) -> str:
    return ", ".join(f"{changed.get(column, column)} AS {column}" for column in columns)


CUSTOMER_SILVER = (
    "SELECT "
    + select_list(
        CUSTOMER_COLUMNS,
        {
            "customer_id": "replace(customer_id, '-', '')",
            "national_id": "replace(national_id, '-', '')",
            "phone_mobile": phone("phone_mobile"),
            "phone_home": phone("phone_home"),
            "address_line2": "coalesce(address_line2, 'Not Available')",
            "dealer_id": "replace(dealer_id, '-', '')",
            "customer_type": initcap("customer_type"),
            "company_name": "coalesce(company_name, 'Not Available')",
        },
    )
    + ", left(dealer_id, 2) AS country_code, right(dealer_id, 6) AS serial_number"
    + f" FROM ({feed('customer')})"
)


def product_silver(source: str, condition: str, country_width: int, more: str = "") -> str:
    return (
        "SELECT "
        + select_list(
            PRODUCT_COLUMNS,
            {
                "dealer_id": "replace(dealer_id, '-', '')",
                "manufacturer": initcap("manufacturer"),
                "legal_name": "replace(legal_name, '-', '')",
            },
        )
        + ", right(replace(dealer_id, '-', ''), 6) AS serial_number"
        + f", left(replace(dealer_id, '-', ''), {country_width}) AS country_code"
        + f"{more} FROM ({source}) WHERE {condition}"
    )


PRODUCT_VALID = product_silver(feed("product"), "length(vin) = 17", 2)
PRODUCT_REASON = (
    ", CASE WHEN vin IS NULL THEN 'VIN is null' ELSE 'VIN length is not 17 digits' END AS rejection_reason"
)
PRODUCT_REJECTED = product_silver(
    feed("product"), "vin IS NULL OR length(vin) <> 17", 3, PRODUCT_REASON
)


def typed_payments(source: str) -> str:
    amounts = """
    amount_paid total_cost parts_cost labour_cost service_charge outstanding_balance
    """.split()
    days = "payment_date service_date due_date service_due_date last_payment_date".split()
    numbers = "days_overdue mileage_at_service".split()
    codes = """
    payment_status payment_method service_type service_status currency card_type vin
    """.split()
    changed = {
        **{column: amount(column) for column in amounts},
        **{column: day(column) for column in days},
        **{column: f"TRY_CAST({column} AS INTEGER)" for column in numbers},
        **{column: f"upper(trim({column}))" for column in codes},
    }
    return f"SELECT {select_list(PAYMENT_COLUMNS, changed)} FROM ({source})"


def payment_silver(condition: str, more: str = "", source: str | None = None) -> str:
    as_text = """
    amount_paid total_cost parts_cost labour_cost service_charge outstanding_balance
    payment_date service_date due_date service_due_date last_payment_date
    days_overdue mileage_at_service
    """.split()
    shown = select_list(PAYMENT_COLUMNS, {column: f"CAST({column} AS VARCHAR)" for column in as_text})
    return (
        f"SELECT {shown}, CASE WHEN typed.days_overdue > 0 THEN 'Y' ELSE 'N' END AS is_overdue,"
        " CASE WHEN payment_method IN ('CARD', 'CASH', 'FINANCE', 'LEASE') THEN payment_method"
        f" ELSE 'OTHER' END AS payment_category{more}"
        f" FROM ({typed_payments(source or feed('payment'))}) AS typed WHERE {condition}"
    )


PAYMENT_OK = (
    "transaction_id IS NOT NULL AND payment_date IS NOT NULL AND vin IS NOT NULL"
    " AND length(vin) = 17 AND amount_paid > 0"
)
PAYMENT_REASON = (
    ", CASE WHEN transaction_id IS NULL THEN 'transaction_id is null'"
    " WHEN payment_date IS NULL THEN 'payment_date is null'"
    " WHEN vin IS NULL THEN 'VIN is null'"
    " WHEN length(vin) <> 17 THEN 'VIN length not 17'"
    " WHEN amount_paid IS NULL THEN 'amount_paid is null'"
    " ELSE 'amount_paid must be > 0' END AS rejection_reason"
)
PAYMENT_VALID = payment_silver(PAYMENT_OK)
PAYMENT_REJECTED = payment_silver(f"({PAYMENT_OK}) IS NOT TRUE", PAYMENT_REASON)

VEHICLE_OWNER = (
    "SELECT c.vin, c.dealer_id, c.phone_mobile, c.first_name, c.country_code, c.serial_number,"
    " c.national_id, p.manufacturer, p.legal_name, p.email, p.system_id, p.sgrp_id"
    f" FROM ({CUSTOMER_SILVER}) c LEFT JOIN ({PRODUCT_VALID}) p ON c.vin = p.vin"
)


def curated_360(normalize_keys: bool, payments: str = PAYMENT_VALID) -> str:
    def key(name: str) -> str:
        return f"replace(o.{name}, '-', '')" if normalize_keys else f"o.{name}"

    return (
        "SELECT o.customer_id, c.customer_type, c.account_status, c.credit_score,"
        " c.payment_method AS customer_payment_method, c.purchase_date,"
        " c.currency AS customer_currency, c.first_name, c.email, c.phone_mobile, c.city, c.country,"
        " p.country_code, p.sgrp_id, p.manufacturer, p.legal_name, p.system_id AS product_system_id,"
        " p.serial_number, o.vin, o.dealer_id, o.payment_date"
        f" FROM ({payments}) o"
        f" LEFT JOIN ({PRODUCT_VALID}) p ON o.vin = p.vin AND {key('dealer_id')} = p.dealer_id"
        f" LEFT JOIN ({CUSTOMER_SILVER}) c ON o.vin = c.vin"
        f" AND {key('customer_id')} = c.customer_id AND {key('dealer_id')} = c.dealer_id"
    )


EVENTS_LATEST = (
    "SELECT event_id, user_id, event_type, value, props FROM"
    " (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank"
    " FROM events) WHERE rank = 1"
)

CORRECTED_FEED = (
    f"SELECT {', '.join(c for c in PAYMENT_COLUMNS if c != 'amount_paid')},"
    " CASE WHEN o_orderstatus = 'O' THEN '1' || amount_paid ELSE amount_paid END AS amount_paid"
    " FROM (SELECT o_orderstatus, "
    + ", ".join(f"{DERIVED['payment'][2][column]} AS {column}" for column in PAYMENT_COLUMNS)
    + " FROM orders)"
)


# Well-formed lines only, so nothing is captured.
FED_PRODUCTS = f"SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM ({feed('product')})"


def rows_in(query: str) -> str:
    return f"(SELECT count(*) FROM ({query}))"


# Each dataset with the layer it is in, what the catalog says of it, and the rows it holds.
DESCRIBED = {
    "product_bronze": ("bronze", "Product feed as delivered", feed("product")),
    "customer_bronze": ("bronze", "Customer feed as delivered", feed("customer")),
    "payment_bronze": ("bronze", "Payment feed as delivered", feed("payment")),
    "product_enriched": ("silver", "Products that passed the quality rules", PRODUCT_VALID),
    "product_rejected": ("silver", "Products that failed a quality rule, with the reason", PRODUCT_REJECTED),
    "customer_enriched": ("silver", "Customers, cleaned", CUSTOMER_SILVER),
    "payment_enriched": (
        "silver", "Payments, cleaned and typed, that passed the quality rules", PAYMENT_VALID
    ),
    "payment_rejected": ("silver", "Payments that failed a quality rule, with the reason", PAYMENT_REJECTED),
    "payment_streaming": ("silver", "Payments, the current version of each transaction", PAYMENT_VALID),
    "vehicle_owner": ("gold", "Customers with the product of the same VIN", VEHICLE_OWNER),
    "curated_360_gold": ("gold", "Payments with product and customer", curated_360(normalize_keys=True)),
}
TIMES = {
    "product_bronze": ("bronze_ingest_timestamp",),
    "customer_bronze": ("bronze_ingest_timestamp",),
    "product_enriched": ("silver_ingest_ts",),
    "product_rejected": ("rejected_at", "silver_ingest_ts"),
    "customer_enriched": ("silver_ingest_timestamp",),
    "payment_enriched": ("silver_ingest_ts",),
    "payment_rejected": ("rejected_at", "silver_ingest_ts"),
}


def described() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{comment}' AS comment, '{layer}' AS quality, '{layer}' AS layer,"
        f" {rows_in(query)} AS total_rows"
        for name, (layer, comment, query) in DESCRIBED.items()
    )


def left_after_drops() -> str:
    gone = ("product_rejected", "vehicle_owner", "payment_streaming", "curated_360_gold")
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, {rows_in(query)} AS total_rows"
        for name, (_, _, query) in DESCRIBED.items()
        if name not in gone
    )


def times() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}.{column}' AS given, {rows_in(DESCRIBED[name][2])} AS total_rows,"
        f" {rows_in(DESCRIBED[name][2])} AS within_run, 'one a batch' AS moments"
        for name, columns in TIMES.items()
        for column in columns
    )


def lineage() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feed, {rows_in(feed(name))} AS total_rows, {rows_in(feed(name))} AS in_their_file"
        for name in FEED_OF
    )


def oracle_sql() -> dict[str, str]:
    view_360 = curated_360(normalize_keys=True)
    return {
        "ingest_product_stream": feed("product", capture="_corrupt_record"),
        "ingest_customer_stream": feed("customer", capture="_corrupt_rec"),
        "ingest_payment_stream": feed("payment", capture="_corrupt_rec"),
        "malformed_product_lines": "SELECT * FROM (" + feed("product", "_corrupt_record")
        + ") WHERE _corrupt_record IS NOT NULL",
        "malformed_customer_lines": "SELECT * FROM (" + feed("customer", "_corrupt_rec")
        + ") WHERE _corrupt_rec IS NOT NULL",
        "malformed_payment_lines": "SELECT * FROM (" + feed("payment", "_corrupt_rec")
        + ") WHERE _corrupt_rec IS NOT NULL",
        "ingest_late_files": f"SELECT * FROM ({FED_PRODUCTS}) UNION ALL SELECT * FROM ({FED_PRODUCTS})",
        "bronze_preview": "SELECT least(10, count(*)) AS shown, least(10, count(*)) AS in_table FROM part",
        "file_lineage": lineage(),
        "given_times": times(),
        "described_tables": described(),
        "dropped_tables": left_after_drops(),
        "bronze_total_rows": "SELECT count(*) AS total_rows FROM part",
        "product_enriched": PRODUCT_VALID,
        "product_rejected": PRODUCT_REJECTED,
        "customer_enriched": CUSTOMER_SILVER,
        "payment_enriched": PAYMENT_VALID,
        "payment_rejected": PAYMENT_REJECTED,
        "silver_stream_product": PRODUCT_VALID,
        "silver_stream_product_rejected": PRODUCT_REJECTED,
        "silver_stream_customer": CUSTOMER_SILVER,
        "silver_stream_payment": PAYMENT_VALID,
        "silver_stream_payment_rejected": PAYMENT_REJECTED,
        "events_scd1": EVENTS_LATEST,
        "events_scd1_stream": EVENTS_LATEST,
        "payment_scd1": PAYMENT_VALID,
        "payment_scd1_stream": PAYMENT_VALID,
        "payment_scd1_corrected_stream": payment_silver(PAYMENT_OK, source=CORRECTED_FEED),
        "vehicle_owner": VEHICLE_OWNER,
        "vehicle_owner_shuffled": VEHICLE_OWNER,
        "vehicle_owner_table": VEHICLE_OWNER,
        "vehicle_owner_export": VEHICLE_OWNER,
        "curated_360": view_360,
        "curated_360_shuffled": view_360,
        "curated_360_ids_as_delivered": curated_360(normalize_keys=False),
        "curated_360_of_current": view_360,
        "curated_360_stream": view_360,
    }
