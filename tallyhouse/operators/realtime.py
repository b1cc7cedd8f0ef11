"""Windowed aggregates of the speed layer, and the merge with the batch layer.

The same functions serve a static frame and a micro-batch. Money arrives as doubles and is summed
as decimals, so a total does not depend on the order in which its parts were added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import or_zero, product_label

WATERMARK = "2 minutes"
PAYMENT_WINDOW = "1 minute"
ITEM_WINDOW = "5 minutes"

# Wide enough for sums of any NUMERIC(10,2) amounts; finer than a cent for computed line totals.
EXACT = "decimal(20,6)"
MONEY = "decimal(22,2)"


def with_window(events: DataFrame, duration: str, watermark: str = WATERMARK) -> DataFrame:
    """Add the start of the event's tumbling window; events without a time have no window and go."""
    return (
        events.filter(F.col("event_time").isNotNull())
        .withWatermark("event_time", watermark)
        .withColumn("window_start", F.window("event_time", duration)["start"])
    )


# --- revenue by minute ------------------------------------------------------------------------


def payment_fits() -> Column:
    """Whether the amount is one that can be summed; a missing one is."""
    return F.col("amount").isNull() | F.col("amount").try_cast(EXACT).isNotNull()


def revenue_partials(payments: DataFrame) -> DataFrame:
    """Amount per window and order. Partials of several micro-batches add up; amounts that do not fit are left out."""
    fitting = payments.filter(payment_fits())
    return fitting.groupBy("window_start", "order_id").agg(F.sum(F.col("amount").try_cast(EXACT)).alias("amount"))


def revenue_windows(partials: DataFrame) -> DataFrame:
    """Distinct orders and revenue per window, from payments or from their partials."""
    return partials.groupBy("window_start").agg(
        F.countDistinct("order_id").alias("order_count"),
        or_zero(F.sum(F.col("amount").cast("decimal(30,6)"))).cast(MONEY).alias("revenue"),
    )


def revenue_totals(payments: DataFrame) -> DataFrame:
    """Orders, money and events per window and bucket of order ids, of a static frame or as the state of a stream.

    A bucket is a range of 32,768 ids, and the orders in it are a bitmap: distinct counts of buckets add up exactly, and
    their number follows from the range of ids in a window, not from its payments. Payments without an order have a
    bucket of their own, without orders."""
    orders = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("order_id")))
    fitting = payments.filter(payment_fits())
    totals = fitting.groupBy(F.window("event_time", PAYMENT_WINDOW).alias("_window"), F.bitmap_bucket_number("order_id").alias("bucket")).agg(
        orders.alias("order_count"),
        or_zero(F.sum(F.col("amount").try_cast(EXACT))).cast("decimal(30,6)").alias("revenue"),
        F.count(F.lit(1)).alias("events"),
    )
    return totals.select(F.col("_window.start").alias("window_start"), "bucket", "order_count", "revenue", "events")


def revenue_of_buckets(totals: DataFrame) -> DataFrame:
    """Orders and revenue per window from the totals of its buckets."""
    return totals.groupBy("window_start").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.max("updated_at").alias("updated_at"),
    )


def revenue_by_minute(payments: DataFrame) -> DataFrame:
    return revenue_windows(revenue_partials(payments))


# --- top products -----------------------------------------------------------------------------


def _line_value() -> Column:
    computed = (F.col("quantity") * F.col("unit_price").try_cast(EXACT)).try_cast(EXACT)
    return F.coalesce(F.col("line_total").try_cast(EXACT), computed, F.lit(0).cast(EXACT))


def item_fits() -> Column:
    """Whether the line's money can be summed: the total, or else what it would be computed from."""
    total, price = F.col("line_total"), F.col("unit_price")
    small = F.abs(F.col("quantity") * price) < 1e14
    return F.when(total.isNotNull(), total.try_cast(EXACT).isNotNull()).otherwise(
        price.isNull() | F.col("quantity").isNull() | (price.try_cast(EXACT).isNotNull() & small)
    )


def product_partials(items: DataFrame) -> DataFrame:
    """Units and revenue per window and product; a missing line total is computed, else 0. Lines that do not fit are
    left out."""
    return (
        items.filter(item_fits())
        .groupBy("window_start", "product_id")
        .agg(or_zero(F.sum("quantity")).alias("units_sold"), or_zero(F.sum(_line_value())).alias("revenue"))
    )


def product_totals(items: DataFrame) -> DataFrame:
    """Units, revenue and events per window and product, of a static frame or as the state of a stream."""
    totals = (
        items.filter(item_fits())
        .groupBy(F.window("event_time", ITEM_WINDOW).alias("_window"), "product_id")
        .agg(
            or_zero(F.sum("quantity")).alias("units_sold"),
            or_zero(F.sum(_line_value())).cast(MONEY).alias("revenue"),
            F.count(F.lit(1)).alias("events"),
        )
    )
    return totals.select(F.col("_window.start").alias("window_start"), "product_id", "units_sold", "revenue", "events")


def product_windows(partials: DataFrame) -> DataFrame:
    """Add up partials of the same window and product."""
    return partials.groupBy("window_start", "product_id").agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum(F.col("revenue").cast("decimal(30,6)")).cast(MONEY).alias("revenue"),
    )


def with_product_names(frame: DataFrame, products: DataFrame) -> DataFrame:
    """Left join of the product names, for streams too. Spark broadcasts them if they are small."""
    return frame.join(products.select("product_id", "product_name"), "product_id", "left")


def top_products_5min(items: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per five minutes and product. Names join the totals, one row per window and product."""
    return with_product_names(product_windows(product_partials(items)), products).select(
        "window_start", "product_id", "product_name", "units_sold", "revenue"
    )


def top_windows(sales: DataFrame, limit: int = 20) -> DataFrame:
    """The best rows by revenue over all the given windows."""
    return sales.orderBy(F.desc("revenue"), "window_start", "product_id").limit(limit)


def live_top_products(sales: DataFrame, limit: int = 20) -> DataFrame:
    """The best products of the newest window."""
    newest = sales.agg(F.max("window_start")).scalar()
    return top_windows(sales.filter(F.col("window_start") == newest), limit)


def served_top_products(top_list: DataFrame, limit: int = 10) -> DataFrame:
    """The live list as it is shown: every product has a name, revenue has two decimals."""
    return top_windows(top_list, limit).select(
        product_label(F.col("product_name"), F.col("product_id")).alias("product_name"),
        F.round("revenue", 2).alias("revenue"),
    )


# --- reads of the window table ----------------------------------------------------------------


def latest_window(windows: DataFrame) -> DataFrame:
    """The newest window; (NULL, 0, 0) when nothing was published."""
    newest = F.max_by(F.struct("order_count", "revenue"), "window_start")
    return windows.agg(F.max("window_start").alias("window_start"), newest.alias("row")).select(
        "window_start",
        or_zero(F.col("row.order_count")).alias("order_count"),
        or_zero(F.col("row.revenue")).alias("revenue"),
    )


def window_series(windows: DataFrame, limit: int = 60) -> DataFrame:
    """The newest windows with their order counts, newest first."""
    return windows.select("window_start", "order_count").orderBy(F.desc("window_start")).limit(limit)


# Ranges of poll numbers that are looked at side by side.
POLL_RANGES = 1_024


def poll_history(polls: DataFrame, limit: int = 20) -> DataFrame:
    """The newest polls at which the served window differs from the one served before.

    ``polls`` are the polls that returned a window; their numbers may have gaps. Numbers are dealt to ranges, each with a
    window function of its own; the first poll of a range looks at the last ones of the ranges before, one per range,
    so no task sees the whole log."""
    first, last = polls.agg(F.min("poll_seq")).scalar(), polls.agg(F.max("poll_seq")).scalar()
    position = (F.col("poll_seq") - first) / (last - first + 1).cast("double")
    ranged = polls.withColumn("_range", F.floor(position * POLL_RANGES))
    inside = Window.partitionBy("_range").orderBy("poll_seq", "window_start")
    here = F.struct("poll_seq", "window_start")
    lasts = ranged.groupBy("_range").agg(F.max(here).alias("last")).agg(F.collect_list("last")).scalar()
    earlier = F.array_max(F.filter("_lasts", lambda poll: poll["poll_seq"] < F.col("poll_seq")))["window_start"]
    return (
        ranged.withColumn("_before", F.lag("window_start").over(inside))
        .withColumn("_lasts", F.when(F.col("_before").isNull(), lasts))
        .withColumn("_previous", F.coalesce("_before", earlier))
        .filter(F.col("_previous").isNull() | (F.col("_previous") != F.col("window_start")))
        .select("poll_seq", "window_start", "order_count", "revenue")
        .orderBy(F.desc("poll_seq"))
        .limit(limit)
    )


# --- merge of the layers ----------------------------------------------------------------------


def merge_layers(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """One row from a one-row batch part and a one-row speed part.

    ``batch`` has order_date, batch_orders, batch_revenue; ``speed`` has window_start, speed_orders,
    speed_revenue. A part that is missing counts 0.
    """
    both = batch.unionByName(speed, allowMissingColumns=True).agg(
        F.max("order_date").alias("order_date"),
        F.coalesce(F.max("batch_orders"), F.lit(0)).alias("batch_orders"),
        F.round(or_zero(F.max("batch_revenue")), 2).alias("batch_revenue"),
        F.max("window_start").alias("window_start"),
        F.coalesce(F.max("speed_orders"), F.lit(0)).alias("speed_orders"),
        F.round(or_zero(F.max("speed_revenue")), 2).alias("speed_revenue"),
        F.round(or_zero(F.max("batch_revenue")) + or_zero(F.max("speed_revenue")), 2).alias("merged_revenue"),
    )
    return both.select(
        "order_date",
        "batch_orders",
        "batch_revenue",
        "window_start",
        "speed_orders",
        "speed_revenue",
        (F.col("batch_orders") + F.col("speed_orders")).alias("merged_orders"),
        "merged_revenue",
    )


def lambda_today_revenue(daily: DataFrame, windows: DataFrame, as_of, cutoff=None) -> DataFrame:
    """Today's batch totals plus the newest minute.

    ``cutoff`` is the batch layer's high-water mark: windows that begin up to then are in its totals and would be
    counted twice.
    """
    batch = daily.filter(F.col("order_date") == as_of).agg(
        F.lit(as_of).cast("date").alias("order_date"),
        F.max("order_count").alias("batch_orders"),
        F.max("revenue").alias("batch_revenue"),
    )
    fresh = windows if cutoff is None else windows.filter(F.col("window_start") > cutoff)
    speed = latest_window(fresh).select(
        "window_start",
        F.col("order_count").alias("speed_orders"),
        F.col("revenue").alias("speed_revenue"),
    )
    return merge_layers(batch, speed)
