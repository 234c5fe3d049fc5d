"""Customer cleaning. Customers pass no quality rule: each row is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    country_code,
    dialable,
    or_not_available,
    serial_number,
    without_hyphens,
)
from ..sources.schemas import CUSTOMER


def clean_customers(bronze: DataFrame) -> DataFrame:
    """Country and serial number are taken from the dealer id as delivered, hyphens included.

    All expressions of one ``withColumns`` see the incoming columns, so the order below is no dependency.
    """
    dealer = F.col("dealer_id")
    return bronze.drop(CUSTOMER.capture).withColumns(
        {
            "customer_id": without_hyphens(F.col("customer_id")),
            "national_id": without_hyphens(F.col("national_id")),
            "phone_mobile": dialable(F.col("phone_mobile")),
            "phone_home": dialable(F.col("phone_home")),
            "address_line2": or_not_available(F.col("address_line2")),
            "country_code": country_code(dealer),
            "serial_number": serial_number(dealer),
            "dealer_id": without_hyphens(dealer),
            "customer_type": F.initcap("customer_type"),
            "company_name": or_not_available(F.col("company_name")),
            "silver_ingest_timestamp": F.current_timestamp(),
        }
    )
