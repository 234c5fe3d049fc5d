"""Text repair as built-in column expressions, so that every step stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results must agree on.
COUNTRY_PREFIX = r"^(\+\d+)-"
COUNTRY_PREFIX_SPACED = "$1 "
NOT_AVAILABLE = "Not Available"
SERIAL_LENGTH = 6


def without_hyphens(text: Column) -> Column:
    """Every hyphen removed. A plain replacement: no pattern has to be matched."""
    return F.replace(text, F.lit("-"), F.lit(""))


def dialable(phone: Column) -> Column:
    """``+91-98765-43210`` becomes ``+91 9876543210``; a number without country part only loses hyphens."""
    return without_hyphens(F.regexp_replace(phone, COUNTRY_PREFIX, COUNTRY_PREFIX_SPACED))


def or_not_available(text: Column) -> Column:
    return F.coalesce(text, F.lit(NOT_AVAILABLE))


def upper_trimmed(text: Column) -> Column:
    """Blanks cut at both ends (tabs stay), then upper case."""
    return F.upper(F.trim(text))


def country_code(dealer_id: Column, width: int = 2) -> Column:
    return F.substring(dealer_id, 1, width)


def serial_number(dealer_id: Column) -> Column:
    """The last six characters; a shorter text is returned whole."""
    return F.substring(dealer_id, -SERIAL_LENGTH, SERIAL_LENGTH)
