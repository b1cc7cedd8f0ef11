"""Dashboard calculations: totals, shares, buckets, trends.

Shares divide by a scalar subquery over the same aggregate, so no window gathers all rows in one
task and the total travels as a single value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import list_limit, or_zero, percent_change, percent_of, ratio, shorten

# Labels in the order of the calendar week.
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

# Label and inclusive upper bound, ascending; None is unbounded.
SPEND_BUCKETS: tuple[tuple[str, float | None], ...] = (
    ("< R1k", 1_000),
    ("R1k–5k", 5_000),
    ("R5k–15k", 15_000),
    ("R15k–40k", 40_000),
    ("R40k+", None),
)


def revenue_summary(days: DataFrame) -> DataFrame:
    totals = days.agg(
        or_zero(F.sum("revenue")).alias("total_revenue"),
        or_zero(F.sum("order_count")).alias("total_orders"),
        or_zero(F.sum("units_sold")).alias("total_units"),
    )
    return totals.withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))


def last_n_days(daily: DataFrame, n: int = 30) -> DataFrame:
    """The newest ``n`` rows; days without orders have no row and are not counted."""
    return daily.orderBy(F.desc("order_date")).limit(n)


def revenue_trend(daily: DataFrame) -> DataFrame:
    """Every day, newest first, with its own average order value."""
    return daily.select(
        "order_date",
        "order_count",
        "revenue",
        "units_sold",
        ratio(F.col("revenue"), F.col("order_count")).alias("avg_order_value"),
    ).orderBy(F.desc("order_date"))


def latest_change(daily: DataFrame) -> DataFrame:
    """Newest day against the row before it, in percent."""
    day = F.struct("order_date", "revenue", "order_count")
    newest = (
        last_n_days(daily, 2)
        .agg(F.max(day).alias("latest"), F.min(day).alias("earliest"), F.count(F.lit(1)).alias("days"))
        .withColumn("previous", F.when(F.col("days") == 2, F.col("earliest")))
    )
    return newest.filter("days > 0").select(
        F.col("latest.order_date").alias("order_date"),
        F.col("latest.revenue").alias("revenue"),
        F.col("previous.revenue").alias("previous_revenue"),
        percent_change(F.col("latest.revenue"), F.col("previous.revenue")).alias("revenue_change"),
        F.col("latest.order_count").alias("order_count"),
        F.col("previous.order_count").alias("previous_order_count"),
        percent_change(F.col("latest.order_count"), F.col("previous.order_count")).alias("orders_change"),
    )


def category_breakdown(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "category")
    )


def with_share(frame: DataFrame, measure: str, name: str = "percent") -> DataFrame:
    """Each row's part of the frame's total of ``measure``, in percent; 0 if the total is 0."""
    total = frame.agg(or_zero(F.sum(measure))).scalar()
    return frame.withColumn(name, percent_of(F.col(measure), total))


def region_shares(regions: DataFrame) -> DataFrame:
    return with_share(regions, "customer_count")


def category_shares(products: DataFrame) -> DataFrame:
    return with_share(category_breakdown(products), "revenue")


def _listed(top: DataFrame, limit: int) -> DataFrame:
    """The top list with its total and best revenue; the windows only ever see ``limit`` rows."""
    limit = list_limit(limit)
    whole = Window.partitionBy()
    best_first = [F.desc_nulls_last("revenue"), F.col("product_id")]
    return (
        top.orderBy(*best_first)
        .limit(limit)
        .select(
            F.row_number().over(Window.orderBy(*best_first)).cast("bigint").alias("position"),
            "product_id",
            "product_name",
            "category",
            "revenue",
            F.sum("revenue").over(whole).alias("total"),
            F.max("revenue").over(whole).alias("best"),
        )
    )


def product_revenue_share(top: DataFrame, limit: int = 10) -> DataFrame:
    """Position and share of each listed product in the list's own revenue."""
    listed = _listed(top, limit).withColumn("percent", percent_of(F.col("revenue"), F.col("total")))
    return listed.drop("total", "best")


def product_bar_width(top: DataFrame, limit: int = 5) -> DataFrame:
    """Revenue relative to the best product, for the first ``limit`` rows."""
    best = F.when(F.col("best") == 0, F.lit(1.0)).otherwise(F.col("best").cast("double"))
    return _listed(top, limit).withColumn("width", F.col("revenue").cast("double") / best * 100).drop("total", "best")


def product_totals(products: DataFrame) -> DataFrame:
    """Totals over a product list and its best seller."""
    best = F.max_by("product_name", F.struct("revenue", -F.col("product_id")))
    return products.agg(
        or_zero(F.sum("revenue")).alias("total_revenue"),
        or_zero(F.sum("units_sold")).alias("total_units"),
        F.count(F.lit(1)).alias("product_count"),
        best.alias("top_product"),
    )


def top_product_chart(products: DataFrame, limit: int = 8, width: int = 16) -> DataFrame:
    return (
        products.orderBy(F.desc_nulls_last("revenue"), "product_id")
        .limit(limit)
        .select("product_id", shorten(F.col("product_name"), width).alias("name"), "revenue")
    )


def _scaffold(frame: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per label with its position, whether or not the data has it."""
    rows = [(i, label) for i, label in enumerate(labels)]
    return frame.sparkSession.createDataFrame(rows, "position int, label string")


def weekday_averages(daily: DataFrame) -> DataFrame:
    """Mean revenue per weekday over the days that exist; 0 for a weekday without any."""
    means = daily.groupBy((F.dayofweek("order_date") - 1).alias("position")).agg(
        (F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("mean")
    )
    return (
        _scaffold(daily, WEEKDAYS)
        .join(means, "position", "left")
        .select("position", "label", F.coalesce("mean", F.lit(0.0)).alias("average"))
        .orderBy("position")
    )


def spend_distribution(
    customers: DataFrame, buckets: Sequence[tuple[str, float | None]] = SPEND_BUCKETS
) -> DataFrame:
    """Customers per spend bucket: the first whose bound is not below the spend; empty ones stay."""
    spend = F.col("total_order_value").cast("double")
    bucket = reduce(
        lambda later, i: F.when(
            spend.isNotNull() if buckets[i][1] is None else spend <= buckets[i][1], F.lit(i)
        ).otherwise(later),
        reversed(range(len(buckets))),
        F.lit(None).cast("int"),
    )
    counts = customers.groupBy(bucket.alias("position")).agg(F.count(F.lit(1)).alias("n"))
    return (
        _scaffold(customers, [label for label, _ in buckets])
        .join(counts, "position", "left")
        .select("position", "label", F.coalesce("n", F.lit(0)).alias("customer_count"))
        .orderBy("position")
    )
