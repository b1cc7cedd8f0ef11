"""Row schemas of the change stream and of the stores the speed layer writes."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCE_TABLES = ("customers", "products", "orders", "order_items", "payments")

# Columns the source computes itself; they are not loaded but derived again.
GENERATED_COLUMNS = {"order_items": {"line_total": "CAST(quantity * unit_price AS DECIMAL(10,2))"}}

# The rows as the change envelopes carry them.
PAYMENT_ROW = T.StructType(
    [
        T.StructField("payment_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("payment_status", T.StringType()),
        T.StructField("paid_at", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

ORDER_ITEM_ROW = T.StructType(
    [
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("line_total", T.DoubleType()),
        T.StructField("created_at", T.StringType()),
    ]
)


REGION_SEED = T.StructType([T.StructField("country", T.StringType()), T.StructField("region", T.StringType())])

# Who published a row of a log: the stream's generation and its micro-batch, and when.
_PUBLISHED = [
    T.StructField("events", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("generation", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]

# Append-only logs of running totals, one folder per micro-batch: a row holds all of its key so far.
REVENUE_STAGING = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("revenue", T.DecimalType(30, 6)),
        *_PUBLISHED,
    ]
)

PRODUCT_STAGING = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("units_sold", T.LongType()),
        T.StructField("revenue", T.DecimalType(22, 2)),
        *_PUBLISHED,
    ]
)

# The same after compaction, with the times a key first came in and was last folded.
_FOLDED = [T.StructField("first_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())]
REVENUE_STORED = T.StructType([*REVENUE_STAGING.fields, *_FOLDED])
PRODUCT_STORED = T.StructType([*PRODUCT_STAGING.fields, *_FOLDED])

# As they are read.
REVENUE_BY_MINUTE = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("revenue", T.DecimalType(22, 2)),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
TOP_PRODUCTS_5MIN = T.StructType([*PRODUCT_STAGING.fields[:5], T.StructField("ingested_at", T.TimestampType())])

# What became of the events of a micro-batch.
ACCOUNTS = T.StructType(
    [
        T.StructField("generation", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("events", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("late", T.LongType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("failed_task", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)
