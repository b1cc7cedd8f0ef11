"""Column expressions shared by the operators."""

from tallyhouse.functions.columns import (
    CANCELLED_STATUSES,
    age_seconds,
    clean,
    clean_lower,
    list_limit,
    not_cancelled,
    or_zero,
    percent_change,
    percent_of,
    product_label,
    ratio,
    shorten,
)

__all__ = [
    "CANCELLED_STATUSES",
    "age_seconds",
    "clean",
    "clean_lower",
    "list_limit",
    "not_cancelled",
    "or_zero",
    "percent_change",
    "percent_of",
    "product_label",
    "ratio",
    "shorten",
]
