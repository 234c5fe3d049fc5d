from .delimited import NO_AGE_LIMIT, malformed, read_feed, stream_feed, well_formed
from .schemas import CUSTOMER, FEEDS, PAYMENT, PRODUCT, Feed

__all__ = [
    "CUSTOMER",
    "FEEDS",
    "Feed",
    "NO_AGE_LIMIT",
    "PAYMENT",
    "PRODUCT",
    "malformed",
    "read_feed",
    "stream_feed",
    "well_formed",
]
