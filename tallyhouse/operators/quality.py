"""Data checks. Each returns the violations; no row means the check holds.

The four generic checks are declared in the tables below, the rules are functions. Values are
grouped before any join or shuffle, so a hot value costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.orders import items_per_order

Tables = Mapping[str, DataFrame]

# Columns that must be filled.
NOT_NULL = {
    "stg_customers": ("customer_id", "email", "country"),
    "stg_products": ("product_id", "product_name", "unit_price"),
    "stg_orders": ("order_id", "customer_id", "order_date", "order_status"),
    "stg_order_items": ("order_item_id", "order_id", "product_id", "quantity"),
    "stg_payments": ("payment_id", "order_id", "amount", "payment_status", "payment_method"),
    "dim_customers": ("customer_id", "email", "region"),
    "dim_products": ("product_id", "product_name"),
    "fact_orders": ("order_id", "customer_id"),
    "fact_payments": ("payment_id", "order_id"),
    "mart_daily_revenue": ("order_date", "order_count", "revenue"),
    "mart_top_products": ("product_id", "units_sold", "revenue"),
    "mart_customer_metrics": ("customer_id", "order_count"),
    "source_row_counts": ("table_name", "row_count", "checked_at"),
    "source_freshness": ("table_name", "table_type", "latest_source_timestamp", "checked_at", "source_age"),
}

# Columns without repeated values.
UNIQUE = {
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "stg_payments": "payment_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "fact_orders": "order_id",
    "fact_payments": "payment_id",
    "mart_daily_revenue": "order_date",
    "mart_top_products": "product_id",
    "mart_customer_metrics": "customer_id",
    "source_row_counts": "table_name",
    "source_freshness": "table_name",
}

# Child table, key, parent table (the key has the same name there).
RELATIONSHIPS = (
    ("stg_orders", "customer_id", "stg_customers"),
    ("stg_order_items", "order_id", "stg_orders"),
    ("stg_order_items", "product_id", "stg_products"),
    ("stg_payments", "order_id", "stg_orders"),
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_payments", "order_id", "fact_orders"),
)

# The only values a column may hold.
ACCEPTED_VALUES = (
    ("stg_orders", "order_status", ("cancelled", "paid", "placed", "shipped")),
    ("stg_payments", "payment_status", ("failed", "pending", "success")),
    ("stg_payments", "payment_method", ("card", "eft", "wallet")),
    ("source_freshness", "table_type", ("transactional", "reference")),
)

# Fewest rows each source table must have.
MIN_ROWS = {
    "customers": 5_000,
    "products": 5,
    "orders": 50_000,
    "order_items": 100_000,
    "payments": 50_000,
}

# Fixed value: largest difference two money totals may show.
TOLERANCE = 0.01


# --- generic checks ---------------------------------------------------------------------------


def not_null(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(F.col(column).isNull())


def unique(frame: DataFrame, column: str) -> DataFrame:
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows that hold them."""
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return keys.join(parent.select(F.col(field).alias("value")).distinct(), "value", "left_anti")


def accepted_values(frame: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return (
        frame.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# --- rules ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A rule that looks at one row of one table: what violates it, and the columns that show the violation."""

    table: str
    violation: Column
    columns: tuple[str, ...]


def _negative(table: str, key: str, column: str) -> RowRule:
    return RowRule(table, F.col(column) < 0, (key, column))


def beyond_tolerance(left: Column, right: Column) -> Column:
    return F.abs(left - right) > F.lit(TOLERANCE).cast("decimal(3,2)")


def row_rules(now: Column | None = None) -> dict[str, RowRule]:
    """The row-level rules by name; ``now`` stands in for the current time."""
    at = F.current_timestamp() if now is None else now
    status = F.col("payment_status")
    value = F.coalesce("order_value", F.lit(0))
    paid = F.coalesce("successful_payment_amount", F.lit(0))
    return {
        "no_future_orders": RowRule("stg_orders", F.col("order_ts") > at, ("order_id", "order_ts", "order_date")),
        "nonneg_customer_order_counts": _negative("mart_customer_metrics", "customer_id", "order_count"),
        "nonneg_line_totals": _negative("stg_order_items", "order_item_id", "line_total"),
        "nonneg_order_counts": _negative("mart_daily_revenue", "order_date", "order_count"),
        "nonneg_item_prices": _negative("stg_order_items", "order_item_id", "unit_price"),
        "nonneg_payments": _negative("stg_payments", "payment_id", "amount"),
        "nonneg_product_prices": _negative("stg_products", "product_id", "unit_price"),
        "nonneg_revenue": _negative("mart_daily_revenue", "order_date", "revenue"),
        "nonneg_units_sold": _negative("mart_top_products", "product_id", "units_sold"),
        "payment_reconciliation": RowRule(
            "fact_orders",
            F.col("order_status").isin("paid", "shipped") & beyond_tolerance(value, paid),
            ("order_id", "order_value", "successful_payment_amount"),
        ),
        "positive_quantities": RowRule("stg_order_items", F.col("quantity") <= 0, ("order_item_id", "quantity")),
        "success_has_paid_at": RowRule(
            "stg_payments",
            (status == "success") & F.col("paid_at").isNull(),
            ("payment_id", "order_id", "payment_status", "paid_at"),
        ),
        "unpaid_has_no_paid_at": RowRule(
            "stg_payments",
            status.isin("failed", "pending") & F.col("paid_at").isNotNull(),
            ("payment_id", "payment_status", "paid_at"),
        ),
    }


def orders_have_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    with_items = items.select("order_id").distinct()
    return orders.select("order_id").join(with_items, "order_id", "left_anti")


def revenue_matches_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    again = items_per_order(items).select("order_id", F.col("order_value").alias("calculated"))
    return (
        orders.select("order_id", "order_value")
        .join(again, "order_id", "left")
        .select("order_id", "order_value", F.coalesce("calculated", F.lit(0)).alias("calculated_order_value"))
        .filter(beyond_tolerance(F.col("order_value"), F.col("calculated_order_value")))
    )


def min_row_counts(counts: DataFrame, minimum: Mapping[str, int] = MIN_ROWS) -> DataFrame:
    floor = F.lit(None).cast("bigint")
    for table, rows in minimum.items():
        floor = F.when(F.col("table_name") == table, F.lit(rows)).otherwise(floor)
    return counts.filter(F.col("row_count") < floor).select("table_name", "row_count")


def _row_violations(name: str) -> Callable[[Tables, Column | None, Mapping[str, int]], DataFrame]:
    def find(tables: Tables, now: Column | None, minimum: Mapping[str, int]) -> DataFrame:
        rule = row_rules(now)[name]
        return tables[rule.table].filter(rule.violation).select(*rule.columns)

    return find


# Names of the row-level rules.
ROW_RULES = (
    "no_future_orders",
    "nonneg_customer_order_counts",
    "nonneg_line_totals",
    "nonneg_order_counts",
    "nonneg_item_prices",
    "nonneg_payments",
    "nonneg_product_prices",
    "nonneg_revenue",
    "nonneg_units_sold",
    "payment_reconciliation",
    "positive_quantities",
    "success_has_paid_at",
    "unpaid_has_no_paid_at",
)

# The sixteen rules by name, over tables by name; ``now`` and ``minimum`` as in the functions above.
RULES: dict[str, Callable[[Tables, Column | None, Mapping[str, int]], DataFrame]] = {
    **{name: _row_violations(name) for name in ROW_RULES},
    "orders_have_items": lambda t, now, minimum: orders_have_items(t["fact_orders"], t["stg_order_items"]),
    "revenue_matches_items": lambda t, now, minimum: revenue_matches_items(t["fact_orders"], t["stg_order_items"]),
    "min_row_counts": lambda t, now, minimum: min_row_counts(t["source_row_counts"], minimum),
}
