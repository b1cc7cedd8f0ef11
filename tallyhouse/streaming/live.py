"""The live path: running totals per window, kept as the state of the stream.

Spark's own stateful aggregation holds the totals of the open windows in RocksDB, in update mode: a trigger publishes
the totals that changed, complete, and reads nothing that earlier ones have written. The watermark drops the state of
windows that are over. Events that arrive after that are not added to anything: they go to a table of late events, as
amounts that cannot be summed go to a table of rejects, and every micro-batch accounts for all its events.

Distinct orders are bitmaps per range of order ids, so the state and what is published do not grow with the payments
of a window.

Published totals belong to a generation, the id Spark gives a checkpoint. A new checkpoint reads the source anew and
starts a generation of its own, whose totals of a window take the place of older ones; a replayed micro-batch
overwrites its own folders. The totals go to an append-only staging log, which ``plans.batch_run`` compacts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import cycle

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tallyhouse.operators import realtime
from tallyhouse.operators.upsert import overwrite_partitions, read_current, read_days, read_or_empty, replace_table
from tallyhouse.schemas import (
    ACCOUNTS,
    ORDER_ITEM_ROW,
    PAYMENT_ROW,
    PRODUCT_STAGING,
    PRODUCT_STORED,
    REVENUE_STAGING,
    REVENUE_STORED,
    TOP_PRODUCTS_5MIN,
)
from tallyhouse.sources.cdc import created_items, parse_changes, successful_payments

TRIGGER = {"processingTime": "15 seconds"}
# What a row of the stream is: a changed total, an event, or an event whose money does not fit.
TOTAL, EVENT, REJECT = "total", "event", "reject"


def payment_events(raw: DataFrame, now: Column | None = None, watermark: str = realtime.WATERMARK) -> DataFrame:
    """Successful payments of a raw change stream, with their one-minute window."""
    payments = successful_payments(parse_changes(raw, PAYMENT_ROW), now)
    return realtime.with_window(payments, realtime.PAYMENT_WINDOW, watermark)


def item_events(raw: DataFrame, watermark: str = realtime.WATERMARK) -> DataFrame:
    """Created order items of a raw change stream, with their five-minute window."""
    return realtime.with_window(created_items(parse_changes(raw, ORDER_ITEM_ROW)), realtime.ITEM_WINDOW, watermark)


def with_totals(events: DataFrame, totals: DataFrame, fits: Column) -> DataFrame:
    """The events beside the totals they change, in one stream, so that a micro-batch sees both."""
    kind = F.when(F.coalesce(fits, F.lit(False)), EVENT).otherwise(REJECT)
    return totals.withColumn("kind", F.lit(TOTAL)).unionByName(events.withColumn("kind", kind), allowMissingColumns=True)


def payment_rows(events: DataFrame) -> DataFrame:
    return with_totals(events, realtime.revenue_totals(events), realtime.payment_fits())


def item_rows(events: DataFrame) -> DataFrame:
    return with_totals(events, realtime.product_totals(events), realtime.item_fits())


def generation_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the checkpoint, which Spark writes before the first micro-batch."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _stamped(frame: DataFrame, generation: str, batch_id: int) -> DataFrame:
    return frame.withColumns({"generation": F.lit(generation), "batch_id": F.lit(batch_id).cast("bigint")})


def _store(frame: DataFrame, generation: str, batch_id: int, path: str) -> None:
    overwrite_partitions(_stamped(frame, generation, batch_id), path, "generation", "batch_id")


def _account(batch: DataFrame, generation: str, batch_id: int, root: str, kind: str, event: Sequence[str]) -> bool:
    """Count the events of a micro-batch and set the rejected and the late ones aside; whether there are any totals.

    An event changes a total of its window unless the watermark had closed the window before, and all events of a window
    fare alike: so the late ones are those of windows without a total."""
    per_window = batch.groupBy("window_start").agg(
        F.count_if(F.col("kind") == TOTAL).alias("totals"),
        F.count_if(F.col("kind") == EVENT).alias("events"),
        F.count_if(F.col("kind") == REJECT).alias("rejected"),
    )
    is_late = (F.col("totals") == 0) & (F.col("events") > 0)
    seen = per_window.agg(
        F.sum("totals").alias("totals"),
        (F.sum("events") + F.sum("rejected")).alias("events"),
        F.sum("rejected").alias("rejected"),
        F.sum(F.when(is_late, F.col("events")).otherwise(0)).alias("late"),
    ).first()
    if not seen["events"]:
        return False
    if seen["rejected"]:
        _store(batch.filter(F.col("kind") == REJECT).select(*event), generation, batch_id, f"{root}/rejected_{kind}")
    if seen["late"]:
        windows = per_window.filter(is_late).select("window_start")
        late = batch.filter(F.col("kind") == EVENT).join(windows, "window_start", "left_semi")
        _store(late.select(*event), generation, batch_id, f"{root}/late_{kind}")
    counts = batch.sparkSession.createDataFrame([(generation, batch_id, seen["events"], seen["rejected"], seen["late"])], ACCOUNTS)
    overwrite_partitions(counts.coalesce(1), f"{root}/accounts_{kind}", "generation", "batch_id")
    return seen["totals"] > 0


def _totals(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """The changed totals of a micro-batch."""
    totals = batch.filter(F.col("kind") == TOTAL).withColumn("ingested_at", F.current_timestamp())
    return totals.select(*[name for name in schema.names if name in totals.columns])


PAYMENT = ("payment_id", "order_id", "amount", "event_time", "window_start")
ITEM = ("product_id", "quantity", "unit_price", "line_total", "event_time", "window_start")


def _published(spark: SparkSession, path: str, schema: T.StructType, generation: str, batch_id: int) -> DataFrame:
    """What this micro-batch has published, from its own folder."""
    stored = spark.read.schema(schema).option("basePath", path)
    return stored.parquet(f"{path}/generation={generation}/batch_id={batch_id}")


def _keep_newest(fresh: DataFrame, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Bring the kept totals of the newest window up to date; a late micro-batch does not take a newer window's place."""
    kept = read_current(fresh.sparkSession, path, schema)
    newest, current = (frame.agg(F.max("window_start")).first()[0] for frame in (fresh, kept))
    if current is None or newest >= current:
        both = newest_totals(fresh.unionByName(kept).withColumn("first_at", F.col("ingested_at")), keys)
        # The totals are made in tasks of their own: a streaming batch has no adaptive execution, and a task that takes
        # over all its partitions holds a sort buffer for each.
        replace_table(both.filter(F.col("window_start") == F.lit(newest)).repartition(1), path, schema)


def publish_revenue(batch: DataFrame, batch_id: int, root: str, generation: str = "0") -> None:
    """Publish the changed totals of a micro-batch of ``payment_rows``; those of the newest window are kept apart, too."""
    if _account(batch, generation, batch_id, root, "payments", PAYMENT):
        staging = f"{root}/revenue_by_minute_staging"
        _store(_totals(batch, REVENUE_STAGING), generation, batch_id, staging)
        fresh = _published(batch.sparkSession, staging, REVENUE_STAGING, generation, batch_id)
        _keep_newest(fresh, f"{root}/revenue_latest", REVENUE_STAGING, ["bucket"])


def publish_top_products(
    batch: DataFrame, batch_id: int, root: str, products: DataFrame, generation: str = "0"
) -> None:
    """The same for ``item_rows``, with the products' names."""
    if _account(batch, generation, batch_id, root, "items", ITEM):
        staging = f"{root}/top_products_5min_staging"
        _store(realtime.with_product_names(_totals(batch, PRODUCT_STAGING), products), generation, batch_id, staging)
        fresh = _published(batch.sparkSession, staging, PRODUCT_STAGING, generation, batch_id)
        _keep_newest(fresh, f"{root}/top_products_live", PRODUCT_STAGING, ["product_id"])


def _start(
    rows: DataFrame, publish: Callable[[DataFrame, int, str], None], name: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    folder = f"{checkpoint}/{name}"
    generation: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        if not generation:
            generation.append(generation_of(batch.sparkSession, folder))
        # The accounts, the set-aside events and the totals are read from one pass over the micro-batch.
        rows = batch.persist()
        try:
            publish(rows, batch_id, generation[0])
        finally:
            rows.unpersist()

    return (
        rows.writeStream.foreachBatch(each)
        .outputMode("update")
        .queryName(name)
        .option("checkpointLocation", folder)
        .trigger(**trigger)
        .start()
    )


def start_revenue(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
    now: Column | None = None,
    watermark: str = realtime.WATERMARK,
) -> StreamingQuery:
    """Publish revenue by minute from a raw stream of payment changes."""

    def publish(batch: DataFrame, batch_id: int, generation: str) -> None:
        publish_revenue(batch, batch_id, root, generation)

    return _start(payment_rows(payment_events(raw, now, watermark)), publish, "revenue_by_minute", checkpoint, trigger)


def start_top_products(
    raw: DataFrame,
    products: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
    watermark: str = realtime.WATERMARK,
) -> StreamingQuery:
    """Publish sales per five minutes and product from a raw stream of item changes."""

    def publish(batch: DataFrame, batch_id: int, generation: str) -> None:
        publish_top_products(batch, batch_id, root, products, generation)

    return _start(item_rows(item_events(raw, watermark)), publish, "top_products_5min", checkpoint, trigger)


class StreamEnded(Exception):
    """One of several streams that belong together has ended; the others were stopped."""


def supervise(queries: Sequence[StreamingQuery], ends: bool, poll_seconds: float = 1.0) -> None:
    """Wait for streams that belong together.

    With ``ends`` they end by themselves and all are waited for. Else the end of one stops the others. In both cases a
    failure stops the others and is raised, with the name of the stream that failed."""
    running = list(queries)
    try:
        for query in cycle(queries):
            if query in running:
                query.awaitTermination(poll_seconds)
                if not query.isActive:
                    running.remove(query)
                    if not ends:
                        raise StreamEnded(f"{query.name} has ended")
            if not running:
                return
    except Exception as cause:
        if isinstance(cause, StreamEnded):
            raise
        raise StreamEnded(f"{query.name} has failed: {cause}") from cause
    finally:
        for other in queries:
            if other.isActive:
                other.stop()


def run_speed_layer(
    spark: SparkSession,
    payments: DataFrame,
    items: DataFrame,
    products: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
    watermark: str = realtime.WATERMARK,
) -> None:
    """Both live queries. With a trigger that ends by itself until both have; else until one of them ends."""
    queries = [
        start_revenue(payments, root, checkpoint, trigger, watermark=watermark),
        start_top_products(items, products, root, checkpoint, trigger, watermark),
    ]
    supervise(queries, ends=bool(trigger.get("availableNow") or trigger.get("once")))


# --- reads --------------------------------------------------------------------------------------


def newest_totals(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest total of each key of a window, with the time the key first came in.

    Only the generation that wrote to a window last counts there."""
    at = F.struct("ingested_at", "batch_id")
    values = [name for name in log.columns if name not in ("window_start", *keys, "first_at")]
    latest = log.groupBy("window_start").agg(F.max_by("generation", at).alias("generation"))
    rows = log.join(latest, ["window_start", "generation"])
    newest = rows.groupBy("window_start", *keys).agg(F.max_by(F.struct(*values), at).alias("row"), F.min("first_at").alias("first_at"))
    return newest.select("window_start", *keys, "row.*", "first_at").select(*log.columns)


def read_revenue_staging(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/revenue_by_minute_staging", REVENUE_STAGING)


def read_product_staging(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/top_products_5min_staging", PRODUCT_STAGING)


def read_compacted_revenue(spark: SparkSession, root: str, days: Sequence | None = None) -> DataFrame:
    return read_days(spark, f"{root}/revenue_by_minute", REVENUE_STORED, days)


def read_compacted_products(spark: SparkSession, root: str, days: Sequence | None = None) -> DataFrame:
    return read_days(spark, f"{root}/top_products_5min", PRODUCT_STORED, days)


def overlaid(compacted: DataFrame, staging: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Compacted and staged totals as one log."""
    at = F.col("ingested_at")
    return compacted.unionByName(staging.withColumns({"first_at": at, "updated_at": at if updated_at is None else updated_at}))


def read_revenue_windows(spark: SparkSession, root: str) -> DataFrame:
    """Compacted windows, overlaid by what was published since."""
    log = overlaid(read_compacted_revenue(spark, root), read_revenue_staging(spark, root))
    return realtime.revenue_of_buckets(newest_totals(log, ["bucket"]))


def _served_products(log: DataFrame) -> DataFrame:
    served = newest_totals(log, ["product_id"]).drop("ingested_at").withColumnRenamed("first_at", "ingested_at")
    return served.select(*TOP_PRODUCTS_5MIN.names)


def read_product_windows(spark: SparkSession, root: str) -> DataFrame:
    return _served_products(overlaid(read_compacted_products(spark, root), read_product_staging(spark, root)))


def read_newest_products(spark: SparkSession, root: str) -> DataFrame:
    """Sales of the newest window only; older ones are left out before the overlay."""
    log = overlaid(read_compacted_products(spark, root), read_product_staging(spark, root))
    return _served_products(log.filter(F.col("window_start") == log.agg(F.max("window_start")).scalar()))


def read_latest_revenue(spark: SparkSession, root: str) -> DataFrame:
    return realtime.latest_window(read_revenue_windows(spark, root))


def read_kept_revenue(spark: SparkSession, root: str) -> DataFrame:
    """The newest window as the stream replaced it last; nothing else is read."""
    kept = read_current(spark, f"{root}/revenue_latest", REVENUE_STAGING)
    return realtime.latest_window(realtime.revenue_of_buckets(kept.withColumn("updated_at", F.col("ingested_at"))))


def read_revenue_series(spark: SparkSession, root: str, limit: int = 60) -> DataFrame:
    return realtime.window_series(read_revenue_windows(spark, root), limit)


def read_live_list(spark: SparkSession, root: str, limit: int = 20) -> DataFrame:
    """The best products of the newest five minutes, as the stream replaced them last."""
    kept = read_current(spark, f"{root}/top_products_live", PRODUCT_STAGING)
    return realtime.top_windows(kept.select(*TOP_PRODUCTS_5MIN.names), limit)


def read_set_aside(spark: SparkSession, root: str, fate: str, kind: str) -> DataFrame:
    """The ``late`` or ``rejected`` events of ``payments`` or ``items``, with the micro-batch that met them."""
    ddl = {
        "payments": "payment_id long, order_id long, amount double",
        "items": "product_id long, quantity long, unit_price double, line_total double",
    }[kind]
    schema = T.StructType.fromDDL(f"{ddl}, event_time timestamp, window_start timestamp, generation string, batch_id long")
    return read_or_empty(spark, f"{root}/{fate}_{kind}", schema)


def read_new_accounts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/accounts_{kind}", ACCOUNTS)


def read_accounts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """What became of the events of ``payments`` or ``items``, per micro-batch; all others were published."""
    counts = read_current(spark, f"{root}/accounts_{kind}_folded", ACCOUNTS).unionByName(read_new_accounts(spark, root, kind))
    # A compaction that was cut off leaves what it has folded in both.
    return counts.dropDuplicates(["generation", "batch_id"]).withColumn(
        "published", F.col("events") - F.col("rejected") - F.col("late")
    )


def read_top_products(spark: SparkSession, root: str, limit: int = 10) -> DataFrame:
    """The live list of the newest five minutes, as it is shown."""
    return realtime.served_top_products(read_newest_products(spark, root), limit)
