"""Cleaned views over the five raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import clean, clean_lower

MONEY = "decimal(12,2)"


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        clean("full_name"),
        clean_lower("email"),
        clean("country"),
        "signup_date",
        "created_at",
        "updated_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        clean("product_name"),
        clean("category"),
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        "created_at",
        "updated_at",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        clean_lower("order_status"),
        "order_ts",
        "created_at",
        "updated_at",
        F.to_date("order_ts").alias("order_date"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        F.col("line_total").cast(MONEY).alias("line_total"),
        "created_at",
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "payment_id",
        "order_id",
        F.col("amount").cast(MONEY).alias("amount"),
        clean_lower("payment_method"),
        clean_lower("payment_status"),
        "paid_at",
        "created_at",
    )
