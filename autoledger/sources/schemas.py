"""The three tab-separated feeds: fields by position, every field nullable text."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names of each feed, in file order.
PRODUCT_FIELDS = (
    "dealer_id",
    "sgrp_id",
    "manufacturer",
    "legal_name",
    "email",
    "system_id",
    "vin",
)

CUSTOMER_FIELDS = (
    "customer_id",
    "first_name",
    "last_name",
    "date_of_birth",
    "national_id",
    "email",
    "phone_mobile",
    "phone_home",
    "address_line1",
    "address_line2",
    "city",
    "state",
    "zip_code",
    "country",
    "dealer_id",
    "customer_type",
    "company_name",
    "account_status",
    "vin",
    "purchase_date",
    "ownership_type",
    "credit_score",
    "payment_method",
    "currency",
    "system_id",
    "created_date",
    "last_updated",
)

PAYMENT_FIELDS = (
    "transaction_id",
    "customer_id",
    "vin",
    "dealer_id",
    "card_type",
    "card_last4",
    "amount_paid",
    "currency",
    "payment_date",
    "payment_status",
    "payment_method",
    "service_id",
    "service_type",
    "service_date",
    "service_due_date",
    "mileage_at_service",
    "service_charge",
    "parts_cost",
    "labour_cost",
    "total_cost",
    "service_status",
    "technician_id",
    "outstanding_balance",
    "due_date",
    "days_overdue",
    "last_payment_date",
    "finance_plan_id",
    "system_id",
)


@dataclass(frozen=True)
class Feed:
    """One feed: its fields, the column that keeps malformed lines, and what ingestion adds to a row."""

    name: str
    fields: tuple[str, ...]
    capture: str
    lineage: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        names = (*self.fields, self.capture)
        return T.StructType([T.StructField(name, T.StringType(), True) for name in names])

    def lineage_columns(self) -> dict[str, Column]:
        return {name: F.expr(text) for name, text in self.lineage.items()}


PRODUCT = Feed(
    "product",
    PRODUCT_FIELDS,
    capture="_corrupt_record",
    lineage={
        "file_name": "_metadata.file_name",
        "bronze_ingest_timestamp": "current_timestamp()",
    },
)

CUSTOMER = Feed(
    "customer",
    CUSTOMER_FIELDS,
    capture="_corrupt_rec",
    lineage={
        "file_name": "_metadata.file_name",
        "bronze_ingest_timestamp": "current_timestamp()",
    },
)

# The file's name and time order two versions of a transaction that arrive in one micro-batch and so
# carry the same ingest time.
PAYMENT = Feed(
    "payment",
    PAYMENT_FIELDS,
    capture="_corrupt_rec",
    lineage={
        "file_name": "_metadata.file_name",
        "file_modification_time": "_metadata.file_modification_time",
    },
)

FEEDS = {feed.name: feed for feed in (PRODUCT, CUSTOMER, PAYMENT)}
