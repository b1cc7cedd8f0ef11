"""The hourly batch run: load, build, check, compact, log."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import quality, realtime
from tallyhouse.operators.upsert import (
    delete_folder,
    drop_batches,
    read_current,
    read_days,
    replace_days,
    replace_table,
    upsert_small_table,
)
from tallyhouse.plans import versions
from tallyhouse.plans.check_suite import check_report
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.schemas import ACCOUNTS, PRODUCT_STORED, REVENUE_STORED, RUN_LOG
from tallyhouse.sources.tables import load_raw, read_layer
from tallyhouse.streaming import live


class ChecksFailed(Exception):
    """At least one data check found violations."""


def _closed_batches(log: DataFrame) -> list[tuple[str, int]]:
    """The published micro-batches there are now, one for each trigger since the last compaction."""
    return [(r["generation"], r["batch_id"]) for r in log.select("generation", "batch_id").distinct().collect()]


def _of(log: DataFrame, folded: list[tuple[str, int]]) -> DataFrame:
    """The rows of the given micro-batches; those that arrive meanwhile stay for the next run."""
    batches = log.sparkSession.createDataFrame(folded, "generation string, batch_id long")
    return log.join(F.broadcast(batches), ["generation", "batch_id"], "left_semi")


def _fold(
    spark: SparkSession,
    staging: DataFrame,
    staged_at: str,
    path: str,
    keys: list[str],
    schema: T.StructType,
    now: Column | None,
) -> None:
    """Fold a staging log into its table by day, then empty what was folded."""
    folded = _closed_batches(staging)
    if not folded:
        return
    # Used for the days and again for the fold; a lost block is computed again from the log.
    rows = _of(staging, folded).persist()
    days = [row["day"] for row in rows.select(F.to_date("window_start").alias("day")).distinct().collect()]
    log = live.overlaid(read_days(spark, path, schema, days), rows, F.current_timestamp() if now is None else now)
    replace_days(live.newest_totals(log, keys), path, schema)
    rows.unpersist()
    drop_batches(spark, staged_at, folded)


def _fold_accounts(spark: SparkSession, root: str, kind: str) -> None:
    new = live.read_new_accounts(spark, root, kind)
    folded = _closed_batches(new)
    if folded:
        path = f"{root}/accounts_{kind}_folded"
        both = read_current(spark, path, ACCOUNTS).unionByName(_of(new, folded).select(*ACCOUNTS.names))
        replace_table(both.dropDuplicates(["generation", "batch_id"]).coalesce(1), path, ACCOUNTS)
        drop_batches(spark, f"{root}/accounts_{kind}", folded)


def compact_revenue(spark: SparkSession, root: str, now: Column | None = None) -> None:
    """Fold the staging log of revenue windows into their table, then empty what was folded."""
    path = f"{root}/revenue_by_minute"
    _fold(spark, live.read_revenue_staging(spark, root), f"{path}_staging", path, ["bucket"], REVENUE_STORED, now)
    _fold_accounts(spark, root, "payments")


def compact_top_products(spark: SparkSession, root: str, now: Column | None = None) -> None:
    """The same for product windows; a known key keeps the time it first came in."""
    path = f"{root}/top_products_5min"
    _fold(spark, live.read_product_staging(spark, root), f"{path}_staging", path, ["product_id"], PRODUCT_STORED, now)
    _fold_accounts(spark, root, "items")


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    dag_id: str,
    started_at: datetime,
    failed_task: str | None,
    published: bool = False,
) -> None:
    """Record a run; one whose layers were published has succeeded, also where a later task of it failed."""
    status = "SUCCESS" if failed_task is None or published else "FAILED"
    now = datetime.now(timezone.utc)
    outcome = spark.createDataFrame([(run_id, dag_id, status, started_at, now, failed_task, now)], RUN_LOG)
    columns = ["status", "finished_at", "failed_task", "recorded_at"]
    upsert_small_table(outcome, path, ["run_id"], columns, RUN_LOG)


def failed_checks(report: DataFrame) -> list[str]:
    """Names of the checks with violations; there are as many rows as declared checks."""
    return sorted(row.check_name for row in report.filter("failures > 0").collect())


def run_batch(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    region_seed: DataFrame,
    root: str,
    run_id: str,
    now: Column | None = None,
    minimum: Mapping[str, int] = quality.MIN_ROWS,
    dag_id: str = "hourly_batch",
) -> dict[str, int]:
    """Load the raw layer, write the marts, check them and, if all holds, publish them and compact the speed layer.

    Readers see the former run's layers until this one is published (``plans.versions``). Returns the rows loaded
    per table. The outcome is logged either way; a compaction that fails after publishing is logged as a success of the
    layers that names the failed task.
    """
    started_at = datetime.now(timezone.utc)
    task, live_now = "extract", False
    version = versions.new_version(root, run_id)
    try:
        loaded = load_raw(sources, f"{version}/raw")
        task = "models"
        raw = read_layer(spark, f"{version}/raw")
        warehouse = Warehouse(raw, lambda: region_seed, now)
        warehouse.write_marts(f"{version}/marts")
        task = "checks"
        failures = failed_checks(check_report(warehouse, now, minimum))
        if failures:
            raise ChecksFailed(", ".join(failures))
        task = "publish"
        versions.publish(spark, root, version, high_water(raw["payments"]))
        live_now = True
        task = "compaction"
        compact_revenue(spark, f"{root}/realtime", now)
        compact_top_products(spark, f"{root}/realtime", now)
        versions.drop_old(spark, root)
    except Exception:
        if not live_now:
            delete_folder(spark, version)
        log_run(spark, f"{root}/monitoring/pipeline_runs", run_id, dag_id, started_at, task, live_now)
        raise
    log_run(spark, f"{root}/monitoring/pipeline_runs", run_id, dag_id, started_at, None)
    return loaded


def high_water(payments: DataFrame) -> datetime | None:
    """The event time of the newest payment in the layer; the speed layer's windows up to then are in it."""
    return payments.agg(F.max(F.coalesce("paid_at", "created_at")).alias("at")).first()["at"]


def merged_today(spark: SparkSession, root: str, as_of: Column) -> DataFrame:
    """Today's totals of the published run, and the newest minute after its high-water mark."""
    run = versions.newest(spark, root)
    daily = spark.read.parquet(f"{run['folder']}/marts/mart_daily_revenue")
    windows = live.read_revenue_windows(spark, f"{root}/realtime")
    mark = run["high_water"]
    return realtime.lambda_today_revenue(daily, windows, as_of, None if mark is None else F.lit(mark))
