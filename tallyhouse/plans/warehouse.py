"""The model graph: raw tables to staging, intermediate, marts and monitoring.

Staging, intermediate and monitoring models are lazy frames; marts are persisted by
``write_marts``, and later steps read what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import marts, monitoring, orders, staging
from tallyhouse.plans import versions
from tallyhouse.session import side_by_side

MARTS = (
    "dim_customers",
    "dim_products",
    "fact_orders",
    "fact_payments",
    "mart_daily_revenue",
    "mart_top_products",
    "mart_customer_metrics",
)

# Models of a few rows that the checks read several times.
MONITORING = ("source_row_counts", "source_freshness")

# The key by which rows of a written mart are looked up, and other ids in them.
LOOKED_UP = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "fact_orders": ("order_id", "customer_id"),
    "fact_payments": ("payment_id", "order_id"),
    "mart_top_products": ("product_id",),
    "mart_customer_metrics": ("customer_id",),
}

MODELS = (
    "stg_customers",
    "stg_products",
    "stg_orders",
    "stg_order_items",
    "stg_payments",
    "int_orders_enriched",
    "int_customer_orders",
    *MARTS,
    *MONITORING,
)


class Warehouse:
    """All models over one set of raw tables, none of them computed before it is read."""

    def __init__(
        self, raw: Mapping[str, DataFrame], region_seed: Callable[[], DataFrame], now: Column | None = None
    ):
        self.raw = raw
        self.region_seed = region_seed
        self.now = now
        # Tables that are bucketed, by their key.
        self.bucketed: dict[str, tuple[str, ...]] = {}

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw["payments"])

    @cached_property
    def order_measures(self) -> DataFrame:
        return orders.order_measures(self.stg_orders, self.stg_order_items, self.stg_payments)

    def measures_where(self, kept: Column) -> DataFrame:
        """The order measures of some orders; only their items and payments are aggregated."""
        chosen = self.stg_orders.filter(kept)
        ids = chosen.select("order_id")
        return orders.order_measures(
            chosen,
            self.stg_order_items.join(ids, "order_id", "left_semi"),
            self.stg_payments.join(ids, "order_id", "left_semi"),
        )

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return orders.int_orders_enriched(
            self.stg_orders, self.stg_customers, self.stg_order_items, self.stg_payments
        )

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return orders.int_customer_orders(self.order_measures, self.stg_customers)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers, self.region_seed())

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return marts.fact_orders(self.int_orders_enriched)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return marts.fact_payments(self.stg_payments)

    # The marts below need no customer attribute of the order fact, so they read its measures.

    @cached_property
    def mart_daily_revenue(self) -> DataFrame:
        return marts.mart_daily_revenue(self.order_measures)

    @cached_property
    def mart_top_products(self) -> DataFrame:
        return marts.mart_top_products(self.stg_order_items, self.dim_products, self.order_measures)

    @cached_property
    def mart_customer_metrics(self) -> DataFrame:
        return marts.mart_customer_metrics(self.dim_customers, self.order_measures)

    @cached_property
    def source_row_counts(self) -> DataFrame:
        return monitoring.source_row_counts(self.raw, self.now)

    @cached_property
    def source_freshness(self) -> DataFrame:
        return monitoring.source_freshness(self.raw, self.now)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self) -> None:
        """Make every model a temporary view, for queries in SQL."""
        for name in MODELS:
            self[name].createOrReplaceTempView(name)

    def write_bucketed(self, root: str, database: str, buckets: int) -> None:
        """Persist the order fact and the items as catalogued tables, bucketed and sorted by ``order_id``.

        Joins and sums by order of the two largest tables then need no shuffle, in the checks and in any later query. Take
        for ``buckets`` the bytes of the items over 256 MB or so, but no fewer than the session's shuffle partitions, or Spark
        deals the tables anew where they meet others."""
        for name in ("stg_order_items", "fact_orders"):
            frame: DataFrame = getattr(self, name)
            spark = frame.sparkSession
            table = f"{database}.{name}"
            # One task for each bucket, so a bucket is one sorted file.
            dealt = frame.repartition(buckets, "order_id").sortWithinPartitions("order_id")
            dealt.write.mode("overwrite").bucketBy(buckets, "order_id").sortBy("order_id").option(
                "path", f"{root}/{name}_by_order"
            ).saveAsTable(table)
            setattr(self, name, spark.table(table))
        self.order_measures = self.fact_orders
        self.bucketed["order_id"] = ("stg_order_items", "fact_orders")

    def write_marts(self, root: str) -> None:
        """Persist the marts and the monitoring models, and read them back in place of their plans.

        Facts are laid out by month, so a date filter skips the files of other months; the rebalance hint packs
        small months together and splits a month that is too large for one task. Rows are sorted by the key they are looked
        up by, in ranges of it where a table has no months, and files carry Bloom filters on it and on the ids that
        point elsewhere: a lookup reads the row groups that can hold its key.
        """
        months = {"fact_orders": ("order_month", "order_date"), "fact_payments": ("created_month", "created_at")}

        def write(name: str) -> None:
            path = f"{root}/{name}"
            frame: DataFrame = getattr(self, name)
            month, column = months.get(name, (None, None))
            key, *others = LOOKED_UP.get(name, (None,))
            blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in (key, *others) if c}
            if month is not None:
                by_month = frame.withColumn(month, F.date_format(column, "yyyy-MM")).hint("rebalance", month)
                by_month.sortWithinPartitions(month, key).write.mode("overwrite").options(**blooms).option(
                    "partitionOverwriteMode", "static"
                ).partitionBy(month).parquet(path)
            elif key is not None:
                frame.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").options(**blooms).parquet(path)
            else:
                frame.write.mode("overwrite").parquet(path)
            stored = frame.sparkSession.read.parquet(path)
            setattr(self, name, stored if month is None else stored.drop(month))

        # The marts over the order fact read what was written of it, the others read the raw tables.
        of_orders = ("mart_daily_revenue", "mart_top_products", "mart_customer_metrics")
        side_by_side(*[partial(write, name) for name in (*MARTS, *MONITORING) if name not in of_orders])
        self.order_measures = self.fact_orders
        side_by_side(*[partial(write, name) for name in of_orders])


def read_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The marts of the newest published run under ``root``."""
    folder = versions.current(spark, root)
    return {name: spark.read.parquet(f"{folder}/marts/{name}") for name in MARTS}
