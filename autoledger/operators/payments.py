"""Payment cleaning and its valid/rejected split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    iso_day,
    money,
    overdue_flag,
    payment_category,
    upper_trimmed,
    whole_number,
)
from ..sources.schemas import PAYMENT
from .products import MALFORMED_LINE, VIN_LENGTH
from .quality import Rule, failing, passing

# The typed fields and the rejection texts that results must agree on.
MONEY_FIELDS = (
    "amount_paid",
    "total_cost",
    "parts_cost",
    "labour_cost",
    "service_charge",
    "outstanding_balance",
)
DAY_FIELDS = (
    "payment_date",
    "service_date",
    "due_date",
    "service_due_date",
    "last_payment_date",
)
NUMBER_FIELDS = (
    "days_overdue",
    "mileage_at_service",
)
CODE_FIELDS = (
    "payment_status",
    "payment_method",
    "service_type",
    "service_status",
    "currency",
    "card_type",
    "vin",
)

TRANSACTION_MISSING = "transaction_id is null"
DATE_MISSING = "payment_date is null"
VIN_MISSING = "VIN is null"
VIN_WRONG_LENGTH = "VIN length not 17"
AMOUNT_MISSING = "amount_paid is null"
AMOUNT_NOT_POSITIVE = "amount_paid must be > 0"
UNKNOWN = "Unknown DQ failure"

_TREATMENT = (
    (MONEY_FIELDS, money),
    (DAY_FIELDS, iso_day),
    (NUMBER_FIELDS, whole_number),
    (CODE_FIELDS, upper_trimmed),
)


def clean_payments(bronze: DataFrame) -> DataFrame:
    """Typed and normalised fields plus two flags; shared by the valid and the rejected side."""
    cleaned = {name: treat(F.col(name)) for names, treat in _TREATMENT for name in names}
    return bronze.withColumns(
        {
            **cleaned,
            "is_overdue": overdue_flag(cleaned["days_overdue"]),
            "payment_category": payment_category(cleaned["payment_method"]),
            "silver_ingest_ts": F.current_timestamp(),
        }
    )


def payment_rules(reject_malformed: bool = False) -> list[Rule]:
    """In the order in which reasons are reported."""
    rules = [
        Rule(TRANSACTION_MISSING, F.col("transaction_id").isNull()),
        Rule(DATE_MISSING, F.col("payment_date").isNull()),
        Rule(VIN_MISSING, F.col("vin").isNull()),
        Rule(VIN_WRONG_LENGTH, F.length("vin") != VIN_LENGTH),
        Rule(AMOUNT_MISSING, F.col("amount_paid").isNull()),
        Rule(AMOUNT_NOT_POSITIVE, F.col("amount_paid") <= 0),
    ]
    if reject_malformed:
        rules.append(Rule(MALFORMED_LINE, F.col(PAYMENT.capture).isNotNull()))
    return rules


def valid_payments(bronze: DataFrame, reject_malformed: bool = False) -> DataFrame:
    return passing(clean_payments(bronze), payment_rules(reject_malformed))


def rejected_payments(bronze: DataFrame, reject_malformed: bool = False) -> DataFrame:
    return failing(clean_payments(bronze), payment_rules(reject_malformed), otherwise=UNKNOWN)
