"""Product cleaning and its valid/rejected split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import country_code, serial_number, without_hyphens
from .quality import Rule, failing, passing

# Texts and widths that results must agree on.
VIN_LENGTH = 17
VIN_MISSING = "VIN is null"
VIN_WRONG_LENGTH = "VIN length is not 17 digits"
UNKNOWN = "Unknown"
VALID_COUNTRY_WIDTH = 2
REJECTED_COUNTRY_WIDTH = 3

MALFORMED_LINE = "line is malformed"


def clean_products(bronze: DataFrame, country_width: int = VALID_COUNTRY_WIDTH) -> DataFrame:
    """Country and serial number are taken from the dealer id after its hyphens are gone."""
    dealer = without_hyphens(F.col("dealer_id"))
    return bronze.withColumns(
        {
            "dealer_id": dealer,
            "manufacturer": F.initcap("manufacturer"),
            "legal_name": without_hyphens(F.col("legal_name")),
            "serial_number": serial_number(dealer),
            "country_code": country_code(dealer, country_width),
            "silver_ingest_ts": F.current_timestamp(),
        }
    )


def product_rules(reject_malformed: bool = False) -> list[Rule]:
    rules = [
        Rule(VIN_MISSING, F.col("vin").isNull()),
        Rule(VIN_WRONG_LENGTH, F.length("vin") != VIN_LENGTH),
    ]
    if reject_malformed:
        rules.append(Rule(MALFORMED_LINE, F.col("_corrupt_record").isNotNull()))
    return rules


def valid_products(bronze: DataFrame, reject_malformed: bool = False) -> DataFrame:
    return passing(clean_products(bronze), product_rules(reject_malformed))


def rejected_products(bronze: DataFrame, reject_malformed: bool = False) -> DataFrame:
    cleaned = clean_products(bronze, country_width=REJECTED_COUNTRY_WIDTH)
    return failing(cleaned, product_rules(reject_malformed), otherwise=UNKNOWN)
