"""The durable path: each window once, after the watermark has closed it, without replayed payments.

Three stateful steps: payments are de-duplicated by id, summed per window and order, then rolled up
to the window. Events later than the watermark are left out here; the live path counts them. The
first row seen of a payment is the one that counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallyhouse.operators.realtime import EXACT, MONEY, PAYMENT_WINDOW, WATERMARK, payment_fits


def closed_revenue_windows(payments: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Distinct orders and revenue per closed minute of a stream with payment_id and event_time.

    A payment without an id is no copy of another one; each gets a key of its own. Amounts that do not fit are left
    out.
    """
    key = F.coalesce(F.col("payment_id").cast("string"), F.uuid())
    once = (
        payments.filter(payment_fits())
        .withColumn("_key", key)
        .withWatermark("event_time", watermark)
        .dropDuplicatesWithinWatermark(["_key"])
    )
    per_order = once.groupBy(F.window("event_time", PAYMENT_WINDOW), "order_id").agg(
        F.sum(F.col("amount").try_cast(EXACT)).alias("amount")
    )
    return (
        per_order.groupBy("window")
        .agg(F.count("order_id").alias("order_count"), F.sum("amount").cast(MONEY).alias("revenue"))
        .select(F.col("window.start").alias("window_start"), "order_count", "revenue")
    )


def start_closed_revenue(payments: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append every closed window to Parquet files exactly once."""
    return (
        closed_revenue_windows(payments)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint}/closed_revenue_windows")
        .trigger(**trigger)
        .start()
    )
