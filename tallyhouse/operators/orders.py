"""Order grain: measures per order, and their roll-up per customer.

``order_id`` and ``customer_id`` are primary keys of the source, so the dimension attributes are
joined after an aggregation instead of being carried through its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import or_zero


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total").alias("order_value"),
    )


def success_payments_per_order(payments: DataFrame) -> DataFrame:
    paid = F.when(F.col("payment_status") == "success", F.col("amount")).otherwise(F.lit(0))
    return payments.groupBy("order_id").agg(F.sum(paid).alias("successful_payment_amount"))


def order_measures(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their item and payment totals, without customer attributes.

    Both right sides hold one row per ``order_id``; Catalyst drops the join whose columns nobody
    reads. Everything is partitioned by ``order_id``: one shuffle per table.
    """
    return (
        orders.join(items_per_order(items), "order_id", "left")
        .join(success_payments_per_order(payments), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            "order_ts",
            "order_date",
            or_zero(F.col("units_sold")).alias("units_sold"),
            or_zero(F.col("order_value")).alias("order_value"),
            or_zero(F.col("successful_payment_amount")).alias("successful_payment_amount"),
        )
    )


def with_customer(measures: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the customer's name, e-mail and country; a hot customer is split by AQE's skew join."""
    who = customers.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        "country",
    )
    return measures.join(who, "customer_id", "left")


def int_orders_enriched(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame
) -> DataFrame:
    return with_customer(order_measures(orders, items, payments), customers).select(
        "order_id",
        "customer_id",
        "customer_name",
        "customer_email",
        "country",
        "order_status",
        "order_ts",
        "order_date",
        "units_sold",
        "order_value",
        "successful_payment_amount",
    )


def orders_per_customer(measures: DataFrame, *by: str) -> DataFrame:
    """Totals per customer over orders of every status, by further columns if any are named."""
    return measures.groupBy("customer_id", *by).agg(
        F.countDistinct("order_id").alias("order_count"),
        or_zero(F.sum("order_value")).alias("total_order_value"),
        or_zero(F.sum("units_sold")).alias("total_units_sold"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("latest_order_date"),
    )


def add_months(by_month: DataFrame) -> DataFrame:
    """Totals per customer from totals per customer and month; no order is in two months."""
    return by_month.groupBy("customer_id").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("total_order_value").alias("total_order_value"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("latest_order_date").alias("latest_order_date"),
    )


def int_customer_orders(measures: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per ordering customer. Aggregates first, so only one row per customer is joined."""
    return with_customer(orders_per_customer(measures), customers).select(
        "customer_id",
        "customer_name",
        "customer_email",
        "country",
        "order_count",
        "total_order_value",
        "total_units_sold",
        "first_order_date",
        "latest_order_date",
    )
