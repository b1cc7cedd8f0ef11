"""Scalar expressions: cleaning, guarded arithmetic, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Both spellings occur in the source.
CANCELLED_STATUSES = ("cancelled", "canceled")


# Ranks up to this limit are applied in every task before the shuffle; above it Spark sorts whole groups.
LARGEST_LIST = 1_000


def list_limit(limit: int) -> int:
    """The limit of a top list, which has to stay small enough for one task."""
    if not 0 < limit <= LARGEST_LIST:
        raise ValueError(f"a list has 1 to {LARGEST_LIST} rows, not {limit}")
    return limit


def clean(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def clean_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name))).alias(name)


def not_cancelled(status: str = "order_status") -> Column:
    """NULL for a NULL status, so a filter drops the row and ``when`` takes the other branch."""
    return ~F.col(status).isin(*CANCELLED_STATUSES)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double; 0 unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(0.0))


def percent_of(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double") * 100).otherwise(F.lit(0.0))


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent; 0 where there is no previous value or it is 0."""
    now, before = current.cast("double"), previous.cast("double")
    return F.when(before.isNotNull() & (before != 0), (now - before) / before * 100).otherwise(F.lit(0.0))


def age_seconds(since: Column, now: Column) -> Column:
    return F.timestamp_diff("SECOND", since, now)


def shorten(text: Column, width: int = 16) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("…"))).otherwise(text)


def product_label(name: Column, product_id: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("product-"), product_id.cast("string")))
