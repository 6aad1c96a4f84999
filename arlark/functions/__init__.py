"""Column builders: every scalar rule of the pipeline as a JVM-side expression."""

from arlark.functions.cleaning import (
    blank_to_null,
    clean_text,
    first_present,
    normalize_payment_method,
    normalize_status,
    parse_bool,
    parse_date,
    parse_decimal,
    parse_int,
    parse_timestamp,
    upper_or_default,
)
from arlark.functions.aging import (
    aging_bucket,
    days_outstanding,
    is_overdue_by_status,
    is_overdue_unpaid,
)
from arlark.functions.ratios import safe_ratio, to_double
from arlark.functions.keys import idempotency_key

__all__ = [
    "aging_bucket",
    "blank_to_null",
    "clean_text",
    "days_outstanding",
    "first_present",
    "idempotency_key",
    "is_overdue_by_status",
    "is_overdue_unpaid",
    "normalize_payment_method",
    "normalize_status",
    "parse_bool",
    "parse_date",
    "parse_decimal",
    "parse_int",
    "parse_timestamp",
    "safe_ratio",
    "to_double",
    "upper_or_default",
]
