from .text import (
    country_code,
    dialable,
    or_not_available,
    serial_number,
    upper_trimmed,
    without_hyphens,
)
from .typed import iso_day, money, overdue_flag, payment_category, whole_number

__all__ = [
    "country_code",
    "dialable",
    "iso_day",
    "money",
    "or_not_available",
    "overdue_flag",
    "payment_category",
    "serial_number",
    "upper_trimmed",
    "whole_number",
    "without_hyphens",
]
