"""Dimensions, facts and metric marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import not_cancelled, or_zero, ratio
from tallyhouse.operators.orders import orders_per_customer


def dim_customers(customers: DataFrame, region_seed: DataFrame) -> DataFrame:
    """Customers with the region of their country; Spark broadcasts the seed once it has seen its size."""
    return customers.join(region_seed, "country", "left").select(
        "customer_id",
        "full_name",
        "email",
        "country",
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        "signup_date",
        "created_at",
        "updated_at",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "unit_price", "created_at", "updated_at")


def fact_orders(enriched: DataFrame) -> DataFrame:
    return enriched.select(
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


def fact_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id", "order_id", "amount", "payment_method", "payment_status", "paid_at", "created_at"
    )


def mart_daily_revenue(orders: DataFrame) -> DataFrame:
    """Orders of every status are counted; money and units come from those not cancelled.

    ``orders`` is the order fact, or the order measures it is made of.
    """
    kept = not_cancelled()
    totals = orders.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("order_count"),
        or_zero(F.sum(F.when(kept, F.col("order_value")).otherwise(F.lit(0)))).alias("revenue"),
        or_zero(F.sum(F.when(kept, F.col("units_sold")).otherwise(F.lit(0)))).alias("units_sold"),
    )
    return totals.withColumn("average_order_value", ratio(F.col("revenue"), F.col("order_count")))


def sold_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items of orders that were not cancelled, with the order's date."""
    kept = orders.filter(not_cancelled()).select("order_id", "order_date")
    return items.select("order_id", "product_id", "quantity", "line_total").join(kept, "order_id")


def mart_top_products(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Units and revenue per product; names are joined to the totals, not to the items."""
    totals = (
        sold_items(items, orders)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("revenue"))
    )
    return named_products(totals, products)


def named_products(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per product with the product's name and category."""
    names = products.select("product_id", "product_name", "category")
    return totals.join(names, "product_id").select(
        "product_id", "product_name", "category", "units_sold", "revenue"
    )


def mart_customer_metrics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer of the dimension with order totals; 0 (and no dates) without orders."""
    return customer_metrics(customers, orders_per_customer(orders))


def customer_metrics(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """Customers with their totals."""
    who = customers.select("customer_id", "full_name", "email", "country", "region")
    return who.join(totals, "customer_id", "left").select(
        "customer_id",
        "full_name",
        "email",
        "country",
        "region",
        or_zero(F.col("order_count")).alias("order_count"),
        or_zero(F.col("total_order_value")).alias("total_order_value"),
        or_zero(F.col("total_units_sold")).alias("total_units_sold"),
        "first_order_date",
        "latest_order_date",
    )
