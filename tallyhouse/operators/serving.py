"""Parameterised reads of the marts: top lists, summaries, product drill-down.

Single-key sorts get the id as a tiebreaker, so a top list is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import list_limit, not_cancelled, or_zero, ratio
from tallyhouse.operators.marts import sold_items


def daily_revenue(daily: DataFrame, limit: int = 30) -> DataFrame:
    return (
        daily.select("order_date", "order_count", "revenue", "units_sold")
        .orderBy(F.desc("order_date"))
        .limit(limit)
    )


def top_products(top: DataFrame, limit: int = 10) -> DataFrame:
    return (
        top.select("product_id", "product_name", "category", "units_sold", "revenue")
        .orderBy(F.desc_nulls_last("revenue"), "product_id")
        .limit(limit)
    )


def customer_metrics(metrics: DataFrame, limit: int = 20) -> DataFrame:
    return (
        metrics.select(
            "customer_id",
            "full_name",
            "email",
            "country",
            "region",
            "order_count",
            "total_order_value",
            "total_units_sold",
            "first_order_date",
            "latest_order_date",
        )
        .orderBy(F.desc_nulls_last("total_order_value"), "customer_id")
        .limit(limit)
    )


def customers_summary(metrics: DataFrame) -> DataFrame:
    totals = metrics.agg(
        F.count(F.lit(1)).alias("customer_count"),
        or_zero(F.sum("order_count")).alias("total_orders"),
        or_zero(F.sum("total_order_value")).alias("total_revenue"),
        or_zero(F.sum("total_units_sold")).alias("total_units"),
    )
    return totals.withColumns(
        {
            "average_customer_spend": ratio(F.col("total_revenue"), F.col("customer_count")),
            "average_orders_per_customer": ratio(F.col("total_orders"), F.col("customer_count")),
        }
    )


def customers_by_region(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("region")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy(F.desc("customer_count"), "region")
    )


def product_exists(products: DataFrame, product_id: int) -> DataFrame:
    """One row if the product is known: an unknown product is not the same as an unsold one."""
    return products.filter(F.col("product_id") == product_id).select("product_id").limit(1)


def _one_product(frame: DataFrame, product_id: int | None) -> DataFrame:
    return frame if product_id is None else frame.filter(F.col("product_id") == product_id)


def product_details(
    products: DataFrame, items: DataFrame, orders: DataFrame, product_id: int | None = None
) -> DataFrame:
    """Attributes and sales of one product, or of every product; unsold products have zeros.

    Sales are rolled up to the product before they meet its attributes. An item whose order is
    missing or cancelled adds nothing, so the inner join to the kept orders loses no measure.
    """
    sales = (
        sold_items(_one_product(items, product_id), orders)
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("units_sold"),
            F.sum("line_total").alias("revenue"),
            F.countDistinct("order_id").alias("order_count"),
        )
    )
    return (
        _one_product(products, product_id)
        .join(sales, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "unit_price",
            "created_at",
            "updated_at",
            or_zero(F.col("units_sold")).alias("units_sold"),
            or_zero(F.col("revenue")).alias("revenue"),
            or_zero(F.col("order_count")).alias("order_count"),
        )
    )


def _latest_per_product(frame: DataFrame, order: list, product_id: int | None, limit: int) -> DataFrame:
    """The ``limit`` newest rows of each product.

    For one product this is a plain top-k. For all of them the rank limit is applied inside every
    task before the shuffle, so a hot product sends ``limit`` rows per task and no more.
    """
    limit = list_limit(limit)
    if product_id is not None:
        return frame.orderBy(*order).limit(limit)
    rank = F.row_number().over(Window.partitionBy("product_id").orderBy(*order))
    return frame.withColumn("position", rank).filter(F.col("position") <= limit).drop("position")


def product_sales_history(
    items: DataFrame, orders: DataFrame, product_id: int | None = None, limit: int = 30
) -> DataFrame:
    """Daily sales of a product over its newest ``limit`` days with sales."""
    days = (
        sold_items(_one_product(items, product_id), orders)
        .groupBy("product_id", "order_date")
        .agg(
            or_zero(F.sum("quantity")).alias("units_sold"),
            or_zero(F.sum("line_total")).alias("revenue"),
            F.countDistinct("order_id").alias("order_count"),
        )
    )
    return _latest_per_product(days, [F.desc("order_date")], product_id, limit)


def product_recent_orders(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    product_id: int | None = None,
    limit: int = 20,
) -> DataFrame:
    """Newest orders of every status that contain a product.

    The join partitions by ``order_id``, which serves the sums per order too; customers are joined
    to the rows that made the list.
    """
    heads = orders.select("order_id", "customer_id", "order_date", "order_status")
    per_order = (
        _one_product(items, product_id)
        .select("order_id", "product_id", "quantity", "line_total")
        .join(heads, "order_id")
        .groupBy("product_id", "order_id", "customer_id", "order_date", "order_status")
        .agg(or_zero(F.sum("quantity")).alias("quantity"), or_zero(F.sum("line_total")).alias("revenue"))
    )
    newest = _latest_per_product(per_order, [F.desc("order_date"), F.desc("order_id")], product_id, limit)
    who = customers.select(
        "customer_id", F.col("full_name").alias("customer_name"), F.col("email").alias("customer_email")
    )
    return newest.join(who, "customer_id", "left").select(
        "product_id",
        "order_id",
        "customer_id",
        "customer_name",
        "customer_email",
        "order_date",
        "order_status",
        "quantity",
        "revenue",
    )


def orders_not_cancelled(orders: DataFrame) -> DataFrame:
    return orders.filter(not_cancelled())


def known_products(requested: DataFrame, products: DataFrame) -> DataFrame:
    """Each requested id once, and whether the catalogue has it."""
    catalogue = products.select("product_id", F.lit(True).alias("is_known"))
    return (
        requested.select("product_id")
        .distinct()
        .join(catalogue, "product_id", "left")
        .select("product_id", F.coalesce("is_known", F.lit(False)).alias("is_known"))
    )
