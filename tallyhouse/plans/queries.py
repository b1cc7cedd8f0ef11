"""Every operator as a query over the retail tables, by name.

Decimals leave as doubles and intervals as seconds, so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tallyhouse.operators import insights, marts, monitoring, orders, quality, realtime, serving, upsert
from tallyhouse.plans import batch_run, incremental, versions
from tallyhouse.plans.check_suite import check_report
from tallyhouse.plans.warehouse import Warehouse, read_marts
from tallyhouse.schemas import ORDER_ITEM_ROW, PAYMENT_ROW, RUN_LOG
from tallyhouse.session import configure, partitions_for, shared_folder
from tallyhouse.sources import cdc, changelog, retail, snapshot, tables
from tallyhouse.streaming import durable, live

# "Now" for the order tables and for the event stream, which end at different times.
ORDERS_NOW = "2001-08-01 00:00:00"
TODAY = "2001-08-01"
EVENTS_NOW = "2024-01-31 00:00:00"
FUTURE_AFTER = "2001-06-30 00:00:00"
ONE_PRODUCT = 7
LAYERS = {"batch": ("Batch",), "speed": ("Speed",), "serving": ("Serving",)}


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


class Inputs:
    """Everything the queries start from, built lazily over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        sizes = [upsert.stored_bytes(spark, f"{folder}/{name}.parquet") for name in retail.TABLES]
        self.spark = configure(spark, partitions_for(spark, sum(sizes)))
        self.folder = folder

    @cached_property
    def star(self) -> retail.LazyTables:
        return retail.star_tables(self.spark, self.folder)

    @cached_property
    def raw(self) -> retail.LazyTables:
        return retail.raw_tables(self.star)

    def new_warehouse(self) -> Warehouse:
        return Warehouse(self.raw, lambda: retail.region_seed(self.star), _stamp(ORDERS_NOW))

    @cached_property
    def warehouse(self) -> Warehouse:
        return self.new_warehouse()

    @cached_property
    def rule_tables(self) -> Warehouse:
        w = self.new_warehouse()
        w.fact_orders = w.order_measures
        return w

    @cached_property
    def events(self) -> DataFrame:
        return self.star["events"]

    @cached_property
    def payment_changes(self) -> DataFrame:
        return cdc.parse_changes(retail.payment_changes(self.events), PAYMENT_ROW)

    @cached_property
    def item_changes(self) -> DataFrame:
        return cdc.parse_changes(retail.item_changes(self.events), ORDER_ITEM_ROW)

    @cached_property
    def payments(self) -> DataFrame:
        return cdc.successful_payments(self.payment_changes, _stamp(EVENTS_NOW))

    @cached_property
    def windowed_payments(self) -> DataFrame:
        return realtime.with_window(self.payments, realtime.PAYMENT_WINDOW)

    @cached_property
    def items(self) -> DataFrame:
        return cdc.created_items(self.item_changes)

    @cached_property
    def windowed_items(self) -> DataFrame:
        return realtime.with_window(self.items, realtime.ITEM_WINDOW)

    @cached_property
    def revenue_windows(self) -> DataFrame:
        return realtime.revenue_by_minute(self.windowed_payments)

    @cached_property
    def product_windows(self) -> DataFrame:
        return realtime.top_products_5min(self.windowed_items, self.warehouse.stg_products)

    @cached_property
    def staging_log(self) -> DataFrame:
        """Window totals as several publishers would append them: one row per hour and event type."""
        return self.events.groupBy(
            F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("window_start"), "event_type"
        ).agg(
            F.countDistinct("user_id").alias("order_count"),
            F.sum(F.col("value").cast("decimal(12,2)")).alias("revenue"),
            F.max(F.col("ts").cast("timestamp")).alias("ingested_at"),
        )

    @cached_property
    def compacted(self) -> DataFrame:
        """Windows an earlier compaction has stored."""
        return self.staging_log.filter(
            (F.col("event_type") == "view") & (F.col("window_start") < _stamp("2024-01-16 00:00:00"))
        ).select("window_start", "order_count", "revenue", F.col("window_start").alias("updated_at"))

    @cached_property
    def polls(self) -> DataFrame:
        """Polls that got a window; those that met an error are missing, so the numbers have gaps."""
        return self.events.filter(F.col("event_type") != "error").select(
            F.col("event_id").alias("poll_seq"),
            F.window(F.col("ts").cast("timestamp"), "5 minutes")["start"].alias("window_start"),
            F.col("user_id").alias("order_count"),
            F.col("value").alias("revenue"),
        )

    @cached_property
    def task_states(self) -> DataFrame:
        kind = F.col("event_type")
        return self.events.select(
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH").alias("run_id"),
            F.concat(F.lit("task_"), (F.col("event_id") % 7).cast("string")).alias("task_id"),
            F.when(kind == "error", "failed").when(kind == "view", "upstream_failed").otherwise("success").alias("state"),
        )

    @cached_property
    def health_checks(self) -> DataFrame:
        w = self.warehouse
        checks = (
            monitoring.stream_staleness(self.revenue_windows, _stamp(EVENTS_NOW), "Speed revenue windows"),
            monitoring.mart_populated_check(w.mart_customer_metrics, "Batch customer mart"),
            monitoring.order_activity_check(self.raw["orders"], _stamp(EVENTS_NOW), "Batch order intake"),
            monitoring.stream_staleness(self.product_windows, _stamp(EVENTS_NOW), "Serving product list"),
        )
        return reduce(DataFrame.unionByName, checks)

    def event_stream(self, folder: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
        """The event files of a folder, or the table itself, as a stream."""
        stream = self.spark.readStream.schema(self.events.schema).option("maxFilesPerTrigger", files_per_trigger)
        return stream.parquet(f"{self.folder}/event[s].parquet" if folder is None else f"{folder}/part-*")

    def add_files(self, folder: str, file: Column, numbers: Sequence[int]) -> None:
        """Write the events of each of these files, one after the other; ``file`` gives an event its file."""
        for number in numbers:
            self.events.filter(file == number).coalesce(1).write.mode("append").parquet(folder)

    @cached_property
    def damaged_payments(self) -> DataFrame:
        """Payment changes as bytes, of which every 11th is cut off and every 13th has an unreadable time."""
        text = F.col("value")
        broken = F.when(F.col("event_id") % 11 == 0, F.substring(text, 1, 25)).otherwise(
            F.when(F.col("event_id") % 13 == 0, F.regexp_replace(text, '"paid_at":"[^"]*"', '"paid_at":"yesterday"')).otherwise(text)
        )
        return retail.payment_changes(self.events, keep=("event_id",)).select(broken.cast("binary").alias("value"))

    def spoiled(self, rule: str) -> dict[str, DataFrame]:
        """If clean tables keep the rule, the table it looks at with violations in some rows."""
        if rule not in retail.SPOILED:
            return {}
        table, column, sql = retail.SPOILED[rule]
        clean = self.rule_tables[table]
        return {table: clean.withColumn(column, F.expr(sql).cast(clean.schema[column].dataType))}


def _newest_event(events: DataFrame, kind: str) -> DataFrame:
    return upsert.latest_per_key(events.filter(F.col("event_type") == kind), ["user_id"], ["ts"])


def _run_outcomes(events: DataFrame, kind: str, status: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    failed = F.concat(F.lit("task_"), (F.col("event_id") % 5).cast("string"))
    return _newest_event(events, kind).select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit(f"{kind}_runs").alias("dag_id"),
        F.lit(status).alias("status"),
        ts.alias("started_at"),
        ts.alias("finished_at"),
        (failed if status == "FAILED" else F.lit(None).cast("string")).alias("failed_task"),
        ts.alias("recorded_at"),
    )


# --- sources and sinks ---------------------------------------------------------------------------


def full_snapshot(q: Inputs) -> DataFrame:
    """Copy the five tables into a raw layer and count what arrived."""
    root = shared_folder(q.spark, "raw")
    tables.load_raw(q.raw, root)
    return monitoring.source_row_counts(tables.read_layer(q.spark, root)).drop("checked_at")


def _as_of(name: str) -> Callable[[Inputs], DataFrame]:
    """A table of the raw layer as of one moment, from scans that came by hours later, each at another time."""

    def build(q: Inputs) -> DataFrame:
        moment = _stamp(ORDERS_NOW)
        keys = {n: key for n, (key, _, _) in retail.UPDATES.items()}
        # The test data repeats some keys of items; of each the greatest row is taken, once for the scan and the log.
        once = {n: upsert.latest_per_key(q.raw[n], [key], []).select(*q.raw[n].columns) for n, key in keys.items()}
        source = shared_folder(q.spark, "source")
        tables.load_raw(once, source, regenerate=False)
        raw = tables.read_layer(q.spark, source)
        scans = {n: retail.scanned_after(n, raw[n], hours) for hours, n in enumerate(keys)}
        logs = {n: retail.envelopes_of(retail.changes_after(n, raw[n]), moment) for n in keys}
        root = shared_folder(q.spark, "snapshot")
        return snapshot.load_as_of(q.spark, scans, logs, keys, moment, root)[name]

    return build


SEGMENTS = 6


def segment_stream(q: Inputs) -> DataFrame:
    """Payments read through the segment source: two segments a trigger, a restart after more segments have come."""
    log, root = shared_folder(q.spark, "segments"), shared_folder(q.spark, "payments")
    segment = (F.col("event_id") % SEGMENTS).alias("segment")
    envelopes = retail.payment_changes(q.events, keep=("event_id",)).select("value", segment)
    for new in (F.col("segment") < 4, F.col("segment") >= 4):
        changelog.write_segments(envelopes.filter(new), log)
        stream = changelog.change_stream(q.spark, log, segments_per_trigger=2)
        payments = cdc.successful_payments(cdc.parse_changes(stream, PAYMENT_ROW), _stamp(EVENTS_NOW))
        running = (
            payments.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint").start()
        )
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    return q.spark.read.parquet(f"{root}/rows")


def seed_csv(q: Inputs) -> DataFrame:
    path = shared_folder(q.spark, "seed")
    retail.region_seed(q.star).write.csv(path, header=True)
    return tables.read_region_seed(q.spark, path)


def regenerated_items(q: Inputs) -> DataFrame:
    items = tables.recompute_generated("order_items", q.raw["order_items"])
    return items.select("order_item_id", "quantity", "unit_price", "line_total")


def price_upsert(q: Inputs) -> DataFrame:
    """Newest observed price per product, written over the catalogue's price."""
    catalogue = q.warehouse.stg_products.select("product_id", "product_name", "unit_price", "updated_at")
    seen = q.items.select("product_id", "unit_price", F.col("event_time").alias("updated_at"))
    newest = upsert.latest_per_key(seen, ["product_id"], ["updated_at"])
    return upsert.keyed_upsert(catalogue, newest, ["product_id"], ["unit_price"])


def run_log(q: Inputs) -> DataFrame:
    log = _run_outcomes(q.events, "signup", "SUCCESS").to(RUN_LOG)
    outcome = _run_outcomes(q.events, "error", "FAILED").drop("recorded_at")
    return upsert.record_run(log, outcome, _stamp(EVENTS_NOW))


def stored_marts(q: Inputs) -> DataFrame:
    """Persist the marts, then read the daily revenue from what was stored."""
    w = q.new_warehouse()
    w.write_marts(shared_folder(q.spark, "marts"))
    return w.mart_daily_revenue


def published_marts(q: Inputs) -> dict[str, DataFrame]:
    """The marts of a published run, read through the pointer."""
    root = shared_folder(q.spark, "shop")
    folder = versions.new_version(root, "run")
    q.new_warehouse().write_marts(f"{folder}/marts")
    versions.publish(q.spark, root, folder)
    return read_marts(q.spark, root)


def stored_lookups(q: Inputs) -> DataFrame:
    """One product and one customer, looked up in published marts."""
    stored = published_marts(q)
    product = stored["mart_top_products"].filter(F.col("product_id") == ONE_PRODUCT)
    customer = stored["mart_customer_metrics"].filter(F.col("customer_id") == ONE_PRODUCT)
    kinds = [product.select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), F.col("units_sold").alias("n"))]
    kinds.append(customer.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id"), F.col("order_count").alias("n")))
    return kinds[0].unionByName(kinds[1])


BUCKETS = 8


def bucketed_report(q: Inputs) -> DataFrame:
    """All checks, with the items and the order fact as catalogued tables bucketed by order."""
    root, w = shared_folder(q.spark, "bucketed"), q.new_warehouse()
    w.write_marts(f"{root}/marts")
    database = f"layers_{uuid.uuid4().hex}"
    q.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/catalog'")
    w.write_bucketed(root, database, BUCKETS)
    return check_report(w, _stamp(FUTURE_AFTER), laid_out=w.bucketed)


def quality_report(q: Inputs) -> DataFrame:
    """All declared checks over persisted marts."""
    w = q.new_warehouse()
    w.write_marts(shared_folder(q.spark, "marts"))
    return check_report(w, _stamp(FUTURE_AFTER))


def _refreshed(q: Inputs) -> str:
    """Layers of two incremental runs.

    The first has every other order, with stale values: other days and customers, cancelled orders, other quantities,
    names and categories, items that will be deleted. The second brings the other half and what has changed."""
    root, seed = shared_folder(q.spark, "incremental"), retail.region_seed(q.star)
    raw, order, item = q.raw, F.col("order_id"), F.col("order_item_id")
    stale = order % 10 == 0
    old_orders = raw["orders"].filter(order % 2 == 0).withColumns(
        {
            "order_ts": F.when(stale, F.col("order_ts") + F.expr("INTERVAL 45 DAYS")).otherwise(F.col("order_ts")),
            "customer_id": F.when(stale, F.col("customer_id") + 1).otherwise(F.col("customer_id")),
            "order_status": F.when(order % 6 == 0, "Cancelled").otherwise(F.col("order_status")),
        }
    )
    items = raw["order_items"]
    doubled = F.when(item % 7 == 0, F.col("quantity") * 2).otherwise(F.col("quantity"))
    extra = items.filter(order % 100 == 0).withColumn("order_item_id", -item)
    first = {
        "customers": raw["customers"].withColumn("full_name", F.concat("full_name", F.lit("son"))),
        "products": raw["products"].withColumn("category", F.lit("new")),
        "orders": old_orders,
        "order_items": items.filter(order % 2 == 0).withColumn("quantity", doubled).unionByName(extra),
        "payments": raw["payments"].filter(order % 2 == 0).withColumn("payment_status", F.lit("pending")),
    }
    incremental.refresh(q.spark, root, "first", first, seed)
    later = {
        "customers": raw["customers"],
        "products": raw["products"],
        "orders": raw["orders"].filter((order % 2 == 1) | stale | (order % 6 == 0)),
        "order_items": items.filter((order % 2 == 1) | (item % 7 == 0))
        .withColumn("_deleted", F.lit(False))
        .unionByName(extra.withColumn("_deleted", F.lit(True))),
        "payments": raw["payments"],
    }
    incremental.refresh(q.spark, root, "second", later, seed)
    return root


def _incremental(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda q: incremental.read_table(q.spark, _refreshed(q), name)


# --- streams --------------------------------------------------------------------------------------


ONCE = {"availableNow": True}


FILES = 4
# The files hold events of all days, so their windows stay open for longer than that.
ALL_DAYS = "60 days"


def _restarted(q: Inputs, start: Callable[[DataFrame, str, str], StreamingQuery], changes) -> str:
    """Run a live stream over files whose windows lie in all of them: one file per trigger, a restart after more files
    have come, then all anew under another checkpoint."""
    root, folder = shared_folder(q.spark, "realtime"), shared_folder(q.spark, "events")
    file = F.col("event_id") % FILES
    for checkpoint, new_files, at_once in (("first", (0, 1), 1), ("first", (2, 3), 1), ("second", (), FILES)):
        q.add_files(folder, file, new_files)
        start(changes(q.event_stream(folder, at_once)), root, f"{root}/checkpoints/{checkpoint}").awaitTermination()
    return root


def _start_revenue(raw: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    return live.start_revenue(raw, root, checkpoint, ONCE, _stamp(EVENTS_NOW), ALL_DAYS)


def live_revenue(q: Inputs) -> DataFrame:
    """What the live revenue stream has published."""
    root = _restarted(q, _start_revenue, retail.payment_changes)
    return live.read_revenue_windows(q.spark, root).drop("updated_at")


def live_top_products(q: Inputs) -> DataFrame:
    def start(raw: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
        return live.start_top_products(raw, q.warehouse.stg_products, root, checkpoint, ONCE, ALL_DAYS)

    return live.read_product_windows(q.spark, _restarted(q, start, retail.item_changes)).drop("ingested_at")


SLICES, DELAY = 6, 2


def _late_root(q: Inputs) -> str:
    """Payments in the order of their time, one file a trigger; every 37th comes two files later, behind the watermark."""
    root, folder = shared_folder(q.spark, "realtime"), shared_folder(q.spark, "events")
    size = q.events.agg(F.max("event_id") + 1).scalar()
    slice_ = F.floor(F.col("event_id") * SLICES / size)
    delayed = (F.col("event_id") % 37 == 0) & (slice_ + DELAY < SLICES)
    q.add_files(folder, F.when(delayed, slice_ + DELAY).otherwise(slice_), range(SLICES))
    raw = retail.payment_changes(q.event_stream(folder, 1))
    # A payment without a time counts when its row was created.
    now = F.try_to_timestamp("after.created_at")
    live.start_revenue(raw, root, f"{root}/checkpoints", ONCE, now).awaitTermination()
    return root


def late_accounts(q: Inputs) -> DataFrame:
    """What became of all events of a stream with late ones, and how many events the published totals hold."""
    root = _late_root(q)
    fates = live.read_accounts(q.spark, root, "payments").agg(*[F.sum(c).alias(c) for c in ("events", "rejected", "late", "published")])
    held = live.newest_totals(
        live.overlaid(live.read_compacted_revenue(q.spark, root), live.read_revenue_staging(q.spark, root)), ["bucket"]
    ).agg(F.sum("events").alias("in_totals"))
    return fates.withColumn("in_totals", held.scalar())


def late_payments(q: Inputs) -> DataFrame:
    """The payments that came too late for their window."""
    return live.read_set_aside(q.spark, _late_root(q), "late", "payments").drop("generation", "batch_id")


def _compacted_revenue_root(q: Inputs) -> str:
    root = shared_folder(q.spark, "realtime")
    _start_revenue(retail.payment_changes(q.event_stream()), root, f"{root}/checkpoints").awaitTermination()
    batch_run.compact_revenue(q.spark, root, _stamp(EVENTS_NOW))
    return root


def _products_root(q: Inputs) -> str:
    root = shared_folder(q.spark, "realtime")
    raw = retail.item_changes(q.event_stream())
    live.start_top_products(raw, q.warehouse.stg_products, root, f"{root}/checkpoints", ONCE, ALL_DAYS).awaitTermination()
    return root


def compacted_revenue(q: Inputs) -> DataFrame:
    """The stored windows after a compaction, and how many rows it left in the staging log."""
    root = _compacted_revenue_root(q)
    left = live.read_revenue_staging(q.spark, root).count()
    stored = realtime.revenue_of_buckets(live.read_compacted_revenue(q.spark, root))
    return stored.withColumn("left_in_staging", F.lit(left).cast("long"))


def served_revenue(q: Inputs) -> DataFrame:
    """The newest window and the series, read as they are served after a compaction."""
    root = _compacted_revenue_root(q)
    newest = live.read_latest_revenue(q.spark, root).select("window_start", "order_count", F.lit("latest").alias("kind"))
    return newest.unionByName(live.read_revenue_series(q.spark, root).withColumn("kind", F.lit("series")))


def kept_window(q: Inputs) -> DataFrame:
    """The newest window that the stream keeps apart, after windows that lie in several files."""
    return live.read_kept_revenue(q.spark, _restarted(q, _start_revenue, retail.payment_changes))


def served_products(q: Inputs) -> DataFrame:
    root = _products_root(q)
    batch_run.compact_top_products(q.spark, root)
    return live.read_top_products(q.spark, root)


def kept_list(q: Inputs) -> DataFrame:
    """The list of the best products that the stream replaces with each update."""
    return live.read_live_list(q.spark, _products_root(q)).drop("ingested_at")


def merged_layers(q: Inputs) -> DataFrame:
    """Today's totals under two published runs: one that ends before the newest minute, and one that already holds it."""
    root, today = shared_folder(q.spark, "layers"), F.lit(EVENTS_NOW).cast("date")
    stream = retail.payment_changes(q.event_stream())
    live.start_revenue(stream, f"{root}/realtime", f"{root}/checkpoints", ONCE, _stamp(EVENTS_NOW), ALL_DAYS).awaitTermination()

    def merged(kind: str, until: str) -> DataFrame:
        loaded = q.payments.filter(F.col("event_time") <= _stamp(until))
        daily = loaded.groupBy(F.to_date("event_time").alias("order_date")).agg(
            F.countDistinct("order_id").alias("order_count"), F.sum(F.col("amount").cast(realtime.MONEY)).alias("revenue")
        )
        folder = versions.new_version(root, kind)
        daily.write.parquet(f"{folder}/marts/mart_daily_revenue")
        versions.publish(q.spark, root, folder, loaded.agg(F.max("event_time")).first()[0])
        return batch_run.merged_today(q.spark, root, today).withColumn("kind", F.lit(kind))

    return merged("before", "2024-01-30 12:00:00").unionByName(merged("overlap", EVENTS_NOW))


def speed_layer(q: Inputs) -> DataFrame:
    """Both live streams together, then a total for each."""
    root = shared_folder(q.spark, "realtime")
    payments, items = retail.payment_changes(q.event_stream()), retail.item_changes(q.event_stream())
    live.run_speed_layer(q.spark, payments, items, q.warehouse.stg_products, root, f"{root}/checkpoints", ONCE, ALL_DAYS)

    def total(frame: DataFrame, kind: str) -> DataFrame:
        return frame.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"), F.sum("revenue").alias("revenue"))

    return total(live.read_revenue_windows(q.spark, root), "revenue").unionByName(
        total(live.read_product_windows(q.spark, root), "products")
    )


def damaged_changes(q: Inputs) -> DataFrame:
    """Unreadable envelopes, payments, and those of them that count at processing time for want of a readable one."""
    payments = cdc.successful_payments(cdc.parse_changes(q.damaged_payments, PAYMENT_ROW), _stamp(EVENTS_NOW))
    at_once = F.count_if(F.col("event_time") == _stamp(EVENTS_NOW)).alias("at_processing_time")
    found = payments.agg(F.lit("payments").alias("kind"), F.count(F.lit(1)).alias("rows"), at_once)
    lost = cdc.unreadable(q.damaged_payments).agg(F.lit("unreadable").alias("kind"), F.count(F.lit(1)).alias("rows"))
    return found.unionByName(lost, allowMissingColumns=True)


def point_lookups(q: Inputs) -> DataFrame:
    """A known and an unknown product by id: one row, as the unknown one has none."""
    products = q.warehouse.dim_products
    return serving.product_exists(products, ONE_PRODUCT).union(serving.product_exists(products, -1))


def closed_revenue(q: Inputs) -> DataFrame:
    """Windows the watermark has closed, each published once."""
    root = shared_folder(q.spark, "realtime")
    changes = cdc.parse_changes(retail.payment_changes(q.event_stream()), PAYMENT_ROW)
    payments = cdc.successful_payments(changes, _stamp(EVENTS_NOW))
    path = f"{root}/closed"
    durable.start_closed_revenue(payments, path, f"{root}/checkpoints", {"availableNow": True}).awaitTermination()
    return q.spark.read.parquet(path)


def _health_fields(checks: DataFrame, *details: str) -> DataFrame:
    return checks.select("name", "status", "message", *[F.col("details")[key].alias(key) for key in details])


def _rule(name: str) -> Callable[[Inputs], DataFrame]:
    # The order fact is read without customer attributes, which no rule looks at.
    def find(q: Inputs) -> DataFrame:
        tables = ChainMap(q.spoiled(name), q.rule_tables)
        return quality.RULES[name](tables, _stamp(FUTURE_AFTER), quality.MIN_ROWS)

    return find


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources
    "src_full_snapshot": full_snapshot,
    **{f"src_as_of_{name}": _as_of(name) for name in retail.UPDATES},
    "src_cdc_stream": segment_stream,
    "src_seed_csv": seed_csv,
    "src_drop_generated": regenerated_items,
    "src_cdc_payments": lambda q: q.payment_changes.select("op", "after.*"),
    "src_cdc_items": lambda q: q.item_changes.select("op", "after.*"),
    # staging, intermediate, marts
    "stg_customers": lambda q: q.warehouse.stg_customers,
    "stg_products": lambda q: q.warehouse.stg_products,
    "stg_orders": lambda q: q.warehouse.stg_orders,
    "stg_order_items": lambda q: q.warehouse.stg_order_items,
    "stg_payments": lambda q: q.warehouse.stg_payments,
    "agg_items_per_order": lambda q: orders.items_per_order(q.warehouse.stg_order_items),
    "agg_success_payment_per_order": lambda q: orders.success_payments_per_order(q.warehouse.stg_payments),
    "int_orders_enriched": lambda q: q.warehouse.int_orders_enriched,
    "int_customer_orders": lambda q: q.warehouse.int_customer_orders,
    "dim_customers": lambda q: q.warehouse.dim_customers,
    "dim_products": lambda q: q.warehouse.dim_products,
    "fact_orders": lambda q: q.warehouse.fact_orders,
    "fact_payments": lambda q: q.warehouse.fact_payments,
    "mart_daily_revenue": lambda q: q.warehouse.mart_daily_revenue,
    "mart_top_products": lambda q: q.warehouse.mart_top_products,
    "mart_customer_metrics": lambda q: q.warehouse.mart_customer_metrics,
    "mart_customer_metrics_recent": lambda q: marts.mart_customer_metrics(
        q.warehouse.dim_customers, q.warehouse.measures_where(F.col("order_date") >= "2001-01-01")
    ),
    "sink_mart_table": stored_marts,
    "inc_fact_orders": _incremental("fact_orders"),
    "inc_daily_revenue": _incremental("mart_daily_revenue"),
    "inc_top_products": _incremental("mart_top_products"),
    "inc_customer_metrics": _incremental("mart_customer_metrics"),
    # filters and projections
    "flt_success_payments": lambda q: q.payments,
    "flt_items_created": lambda q: q.items,
    "flt_not_cancelled": lambda q: serving.orders_not_cancelled(q.warehouse.stg_orders).select(
        "order_id", "order_status", "order_date"
    ),
    "flt_exists": lambda q: serving.known_products(q.items, q.warehouse.dim_products),
    # serving
    "api_daily_revenue": lambda q: serving.daily_revenue(q.warehouse.mart_daily_revenue),
    "api_top_products": lambda q: serving.top_products(q.warehouse.mart_top_products),
    "src_published_marts": lambda q: serving.top_products(published_marts(q)["mart_top_products"]),
    "flt_stored_lookup": stored_lookups,
    "api_customer_metrics": lambda q: serving.customer_metrics(q.warehouse.mart_customer_metrics),
    "customers_summary": lambda q: serving.customers_summary(q.warehouse.mart_customer_metrics),
    "customers_by_region": lambda q: serving.customers_by_region(q.warehouse.dim_customers),
    "product_details": lambda q: serving.product_details(
        q.warehouse.dim_products, q.raw["order_items"], q.warehouse.order_measures
    ),
    "product_sales_history": lambda q: serving.product_sales_history(
        q.raw["order_items"], q.warehouse.order_measures
    ),
    "product_recent_orders": lambda q: serving.product_recent_orders(
        q.raw["order_items"], q.warehouse.order_measures, q.warehouse.stg_customers
    ),
    # dashboard calculations
    "revenue_summary": lambda q: insights.revenue_summary(q.warehouse.mart_daily_revenue),
    "revenue_summary_30_days": lambda q: insights.revenue_summary(
        insights.last_n_days(q.warehouse.mart_daily_revenue, 30)
    ),
    "last_n_days": lambda q: insights.last_n_days(q.warehouse.mart_daily_revenue, 90),
    "revenue_trend": lambda q: insights.revenue_trend(q.warehouse.mart_daily_revenue),
    "percent_change": lambda q: insights.latest_change(q.warehouse.mart_daily_revenue),
    "weekday_averages": lambda q: insights.weekday_averages(q.warehouse.mart_daily_revenue),
    "category_breakdown": lambda q: insights.category_breakdown(q.warehouse.mart_top_products),
    "category_shares": lambda q: insights.category_shares(q.warehouse.mart_top_products),
    "region_shares": lambda q: insights.region_shares(serving.customers_by_region(q.warehouse.dim_customers)),
    "spend_distribution": lambda q: insights.spend_distribution(q.warehouse.mart_customer_metrics),
    "spend_distribution_custom": lambda q: insights.spend_distribution(
        q.warehouse.mart_customer_metrics, (("small", 1_000_000), ("middle", 2_500_000), ("large", None))
    ),
    "product_totals": lambda q: insights.product_totals(q.warehouse.mart_top_products),
    "product_revenue_share": lambda q: insights.product_revenue_share(q.warehouse.mart_top_products),
    "product_bar_width": lambda q: insights.product_bar_width(q.warehouse.mart_top_products),
    "chart_top8": lambda q: insights.top_product_chart(q.warehouse.mart_top_products, width=6),
    # monitoring
    "mon_row_counts": lambda q: q.warehouse.source_row_counts,
    "mon_freshness": lambda q: q.warehouse.source_freshness.drop("source_age"),
    "source_order_count": lambda q: monitoring.source_order_count(q.raw["orders"]),
    "mart_populated_check": lambda q: _health_fields(
        monitoring.mart_populated_check(q.warehouse.mart_customer_metrics), "customer_count", "revenue"
    ),
    "order_activity_check": lambda q: _health_fields(
        monitoring.order_activity_check(q.raw["orders"], _stamp(EVENTS_NOW)), "orders", "age_seconds"
    ),
    "st_staleness": lambda q: _health_fields(
        monitoring.stream_staleness(q.revenue_windows, _stamp(EVENTS_NOW)), "window_start", "age_seconds"
    ),
    "health_summary": lambda q: monitoring.health_summary(q.health_checks),
    "layer_status": lambda q: monitoring.layer_status(q.health_checks, LAYERS),
    "failed_root_tasks": lambda q: monitoring.failed_root_tasks(q.task_states),
    # checks
    "dq_not_null": lambda q: quality.not_null(q.warehouse.stg_payments, "paid_at").select("payment_id", "payment_status"),
    "dq_unique": lambda q: quality.unique(q.warehouse.stg_order_items, "order_item_id"),
    "dq_relationships": lambda q: quality.relationships(
        q.items, "product_id", q.warehouse.stg_products, "product_id"
    ),
    "dq_accepted_values": lambda q: quality.accepted_values(
        q.warehouse.stg_orders, "order_status", ("cancelled", "paid", "placed", "shipped")
    ),
    **{f"dq_{name}": _rule(name) for name in quality.RULES},
    "dq_report": quality_report,
    "dq_report_bucketed": bucketed_report,
    # speed layer over the whole change stream
    "rt_revenue_by_minute": lambda q: q.revenue_windows,
    "rt_top_products_5min": lambda q: q.product_windows,
    "rt_top20": lambda q: realtime.top_windows(q.product_windows),
    "rt_live_top_products": lambda q: realtime.live_top_products(q.product_windows),
    "api_rt_top_products": lambda q: realtime.served_top_products(realtime.top_windows(q.product_windows)),
    "rt_latest_revenue": lambda q: realtime.latest_window(q.revenue_windows),
    "rt_window_series": lambda q: realtime.window_series(q.revenue_windows),
    "rt_history": lambda q: realtime.poll_history(q.polls),
    "stream_static_join": lambda q: realtime.with_product_names(q.windowed_items, q.warehouse.stg_products),
    "lambda_today_revenue": lambda q: realtime.lambda_today_revenue(
        marts.mart_daily_revenue(q.warehouse.measures_where(F.col("order_date") == TODAY)),
        q.revenue_windows,
        F.lit(TODAY).cast("date"),
    ),
    "lambda_published_runs": merged_layers,
    # keyed updates
    "compact_latest": lambda q: upsert.compact_latest(q.staging_log),
    "sink_compact_upsert": lambda q: upsert.compact_upsert(q.compacted, q.staging_log, _stamp(EVENTS_NOW)),
    "sink_upsert": price_upsert,
    "sink_run_log": run_log,
    # streams
    "st_live_revenue": live_revenue,
    "st_live_top_products": live_top_products,
    "st_closed_revenue": closed_revenue,
    "st_speed_layer": speed_layer,
    "st_late_accounts": late_accounts,
    "st_late_payments": late_payments,
    # what is served and kept after streaming
    "compact_realtime": compacted_revenue,
    "rt_served_revenue": served_revenue,
    "rt_served_products": served_products,
    "sink_top_products": kept_list,
    "sink_latest_window": kept_window,
    # one product, damaged input, age as an interval
    "flt_point_lookup": point_lookups,
    "product_details_one": lambda q: serving.product_details(
        q.warehouse.dim_products, q.raw["order_items"], q.warehouse.order_measures, ONE_PRODUCT
    ),
    "product_sales_history_one": lambda q: serving.product_sales_history(
        q.raw["order_items"], q.warehouse.order_measures, ONE_PRODUCT
    ),
    "product_recent_orders_one": lambda q: serving.product_recent_orders(
        q.raw["order_items"], q.warehouse.order_measures, q.warehouse.stg_customers, ONE_PRODUCT
    ),
    "src_cdc_damaged": damaged_changes,
    "mon_source_age": lambda q: q.warehouse.source_freshness.select(
        "table_name", F.extract(F.lit("DAY"), "source_age").cast("long").alias("age_days")
    ),
}


def comparable(frame: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return frame.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: comparable(build(Inputs(spark, folder)))

    return {name: bind(build) for name, build in QUERIES.items()}
