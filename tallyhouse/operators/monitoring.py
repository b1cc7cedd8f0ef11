"""Row counts, freshness, health checks and their roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import age_seconds, or_zero
from tallyhouse.schemas import SOURCE_TABLES

STALE_AFTER_SECONDS = 300

# Kind of table, and the column that tells when its newest row was written.
FRESHNESS = {
    "customers": ("transactional", "updated_at"),
    "products": ("reference", "updated_at"),
    "orders": ("transactional", "updated_at"),
    "order_items": ("transactional", "created_at"),
    "payments": ("transactional", "created_at"),
}

# Worst last.
SEVERITY = ("healthy", "degraded", "unhealthy")


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def source_row_counts(raw: Mapping[str, DataFrame], now: Column | None = None) -> DataFrame:
    counts = [
        raw[table].agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for table in SOURCE_TABLES
    ]
    return _stack(counts).withColumn("checked_at", F.current_timestamp() if now is None else now)


def source_freshness(raw: Mapping[str, DataFrame], now: Column | None = None) -> DataFrame:
    newest = [
        raw[table].agg(
            F.lit(table).alias("table_name"),
            F.lit(kind).alias("table_type"),
            F.max(stamp).alias("latest_source_timestamp"),
        )
        for table, (kind, stamp) in FRESHNESS.items()
    ]
    checked = _stack(newest).withColumn("checked_at", F.current_timestamp() if now is None else now)
    return checked.withColumns(
        {
            "source_age": F.col("checked_at") - F.col("latest_source_timestamp"),
            "source_age_seconds": age_seconds(F.col("latest_source_timestamp"), F.col("checked_at")),
        }
    )


def source_order_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count(F.lit(1)).alias("order_count"))


def _health_row(facts: DataFrame, name: str, cases: Sequence[tuple[Column, str, str]], details: Column) -> DataFrame:
    """A health record from a one-row frame; the first matching (condition, status, message) wins."""
    verdict = F.lit(None).cast("struct<status:string,message:string>")
    for condition, status, message in reversed(cases):
        verdict = F.when(
            condition, F.struct(F.lit(status).alias("status"), F.lit(message).alias("message"))
        ).otherwise(verdict)
    return facts.select(
        F.lit(name).alias("name"),
        verdict.alias("verdict"),
        F.lit(None).cast("double").alias("latency_ms"),
        details.alias("details"),
    ).select("name", "verdict.status", "verdict.message", "latency_ms", "details")


def _details(**values: Column) -> Column:
    pairs = [part for key, value in values.items() for part in (F.lit(key), value.cast("string"))]
    return F.create_map(*pairs)


def stream_staleness(windows: DataFrame, now: Column | None = None, name: str = "stream") -> DataFrame:
    """Degraded when the newest published window is missing or older than the limit."""
    at = F.current_timestamp() if now is None else now
    facts = windows.agg(F.max("window_start").alias("window_start")).withColumn(
        "age_seconds", age_seconds(F.col("window_start"), at)
    )
    cases = [
        (F.col("window_start").isNull(), "degraded", "No realtime window has been published."),
        (F.col("age_seconds") > STALE_AFTER_SECONDS, "degraded", "The newest realtime window is stale."),
        (F.lit(True), "healthy", "Realtime windows are being published."),
    ]
    return _health_row(
        facts, name, cases, _details(window_start=F.col("window_start"), age_seconds=F.col("age_seconds"))
    )


def mart_populated_check(metrics: DataFrame, name: str = "customer mart") -> DataFrame:
    """Degraded when the customer mart is empty."""
    facts = metrics.agg(
        F.count(F.lit(1)).alias("customer_count"), or_zero(F.sum("total_order_value")).alias("revenue")
    )
    cases = [
        (F.col("customer_count") == 0, "degraded", "The customer mart is empty."),
        (F.lit(True), "healthy", "The customer mart is populated."),
    ]
    return _health_row(
        facts, name, cases, _details(customer_count=F.col("customer_count"), revenue=F.col("revenue"))
    )


def order_activity_check(orders: DataFrame, now: Column | None = None, name: str = "order intake") -> DataFrame:
    """Degraded when there are no orders, or the newest is older than the limit."""
    at = F.current_timestamp() if now is None else now
    facts = orders.agg(
        F.count(F.lit(1)).alias("orders"), F.max("created_at").alias("latest_order")
    ).withColumn("age_seconds", age_seconds(F.col("latest_order"), at))
    cases = [
        (F.col("latest_order").isNull(), "degraded", "There are no orders yet."),
        (F.col("age_seconds") > STALE_AFTER_SECONDS, "degraded", "The newest order is stale."),
        (F.lit(True), "healthy", "Orders are arriving."),
    ]
    return _health_row(
        facts,
        name,
        cases,
        _details(
            orders=F.col("orders"), latest_order=F.col("latest_order"), age_seconds=F.col("age_seconds")
        ),
    )


def health_summary(checks: DataFrame) -> DataFrame:
    """Checks per status, and the worst status present; no checks at all count as healthy."""
    counts = checks.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(F.col("status") == status, 1)).alias(status) for status in SEVERITY],
    )
    worst = (
        F.when(F.col("unhealthy") > 0, "unhealthy").when(F.col("degraded") > 0, "degraded").otherwise("healthy")
    )
    return counts.select(worst.alias("status"), "total", *SEVERITY)


def layer_status(checks: DataFrame, layers: Mapping[str, Sequence[str]]) -> DataFrame:
    """Worst status among each layer's checks, in one pass; a layer without checks is healthy.

    A check belongs to a layer if its name contains one of the layer's words.
    """
    severity = F.coalesce(
        *[F.when(F.col("status") == status, F.lit(rank)) for rank, status in enumerate(SEVERITY)]
    )

    def worst(words: Sequence[str]) -> Column:
        belongs = reduce(lambda a, b: a | b, [F.col("name").contains(word) for word in words])
        rank = F.coalesce(F.max(F.when(belongs, severity)), F.lit(0))
        return F.element_at(F.array(*map(F.lit, SEVERITY)), rank + 1)

    rows = [
        F.struct(F.lit(layer).alias("layer"), worst(words).alias("status")) for layer, words in layers.items()
    ]
    return checks.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def failed_root_tasks(tasks: DataFrame) -> DataFrame:
    """Sorted, comma-joined ids of each run's tasks in state ``failed``; NULL if there is none.

    Task states are first reduced to one row per run and task, so the list of a run holds at most
    the tasks its definition names.
    """
    failed = tasks.groupBy("run_id", "task_id").agg(
        F.max(F.col("state") == "failed").alias("has_failed")
    )
    names = F.array_sort(F.collect_list(F.when(F.col("has_failed"), F.col("task_id"))))
    return failed.groupBy("run_id").agg(
        F.nullif(F.concat_ws(", ", names), F.lit("")).alias("failed_task")
    )
