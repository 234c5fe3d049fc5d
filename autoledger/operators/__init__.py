from .customers import clean_customers
from .latest import latest_per_key
from .lookup import KeyPair, left_lookup
from .payments import clean_payments, payment_rules, rejected_payments, valid_payments
from .products import clean_products, product_rules, rejected_products, valid_products
from .quality import Rule, failing, passing

__all__ = [
    "KeyPair",
    "Rule",
    "clean_customers",
    "clean_payments",
    "clean_products",
    "failing",
    "latest_per_key",
    "left_lookup",
    "passing",
    "payment_rules",
    "product_rules",
    "rejected_payments",
    "rejected_products",
    "valid_payments",
    "valid_products",
]
