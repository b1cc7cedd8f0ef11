"""The hourly run: layers on disk, the gate, compaction, the log."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.upsert import read_current
from tallyhouse.plans import batch_run, versions
from tallyhouse.plans.batch_run import ChecksFailed, merged_today, run_batch
from tallyhouse.plans.warehouse import Warehouse, read_marts
from tallyhouse.schemas import RUN_LOG
from tallyhouse.sources.tables import (
    key_ranges,
    load_raw,
    read_layer,
    read_region_seed,
    recompute_generated,
)
from tallyhouse.streaming import live
from tests.conftest import at, rows, seed, shop

FEW = {"customers": 3, "products": 3, "orders": 4, "order_items": 5, "payments": 4}


def now():
    return F.lit("2024-03-03 00:00:00").cast("timestamp")


def stage_one_window(spark, root):
    after = {"payment_id": 1, "order_id": 1, "amount": 7.0, "payment_status": "success", "paid_at": "2024-03-02T10:00:30Z"}
    raw = spark.createDataFrame([(json.dumps({"op": "c", "after": after}),)], "value string")
    live.publish_revenue(live.payment_rows(live.payment_events(raw)), 0, f"{root}/realtime")


def test_good_run_compacts_and_logs(spark, frame, tmp_path):
    root = str(tmp_path)
    stage_one_window(spark, root)
    for _ in range(2):
        assert run_batch(spark, shop(frame), seed(frame), root, "r1", now(), FEW) == FEW
    assert rows(read_marts(spark, root)["mart_daily_revenue"], "order_count") == [(1,), (3,)]
    stored = live.read_compacted_revenue(spark, f"{root}/realtime")
    assert rows(stored, "order_count") == [(1,)]
    assert live.read_revenue_staging(spark, f"{root}/realtime").isEmpty()
    log = read_current(spark, f"{root}/monitoring/pipeline_runs", RUN_LOG)
    assert rows(log, "run_id", "status", "failed_task") == [("r1", "SUCCESS", None)]


def test_failed_checks_stop_the_compaction(spark, frame, tmp_path):
    root = str(tmp_path)
    stage_one_window(spark, root)
    with pytest.raises(ChecksFailed, match="rule:min_row_counts"):
        run_batch(spark, shop(frame), seed(frame), root, "r1", now())
    assert live.read_revenue_staging(spark, f"{root}/realtime").count() == 1
    log = read_current(spark, f"{root}/monitoring/pipeline_runs", RUN_LOG)
    assert rows(log, "status", "failed_task") == [("FAILED", "checks")]


def test_a_run_killed_between_marts_changes_nothing_for_readers(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path)
    run_batch(spark, shop(frame), seed(frame), root, "r1", now(), FEW)
    before = {name: rows(mart) for name, mart in read_marts(spark, root).items()}
    more = shop(frame)
    more["orders"] = more["orders"].withColumn("order_status", F.lit("Cancelled"))
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "mart_top_products", property(lambda self: 1 / 0))
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, more, seed(frame), root, "r2", now(), FEW)
    # A run that fails takes its own folder with it.
    assert len(list((tmp_path / "versions").iterdir())) == 1
    assert {name: rows(mart) for name, mart in read_marts(spark, root).items()} == before
    few = {**FEW, "customers": 4}
    with pytest.raises(ChecksFailed):
        run_batch(spark, shop(frame), seed(frame), root, "r3", now(), few)
    assert {name: rows(mart) for name, mart in read_marts(spark, root).items()} == before
    run_batch(spark, shop(frame), seed(frame), root, "r4", now(), FEW)
    assert versions.current(spark, root).rsplit("/", 1)[1].startswith("r4-")
    # The former version stays for those who read it; failed ones are gone.
    kept = sorted(p.name.split("-")[0] for p in (tmp_path / "versions").iterdir())
    assert kept == ["r1", "r4"]


def test_kept_versions_and_runs_in_progress_stay(spark, tmp_path):
    root = str(tmp_path)
    folders = [versions.new_version(root, f"r{i}") for i in range(5)]
    for folder in folders:
        spark.range(1).write.parquet(f"{folder}/raw")
    for folder in folders[:4]:
        versions.publish(spark, root, folder)
    versions.drop_old(spark, root, keep=3)
    assert [run["folder"] for run in versions.published(spark, root)] == folders[3:0:-1]
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "versions").iterdir()) == ["r1", "r2", "r3", "r4"]
    os.utime(folders[4], (0, 0))
    versions.drop_old(spark, root, keep=200)
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "versions").iterdir()) == ["r1", "r2", "r3"]
    # Old versions of the small table go too.
    assert len(list((tmp_path / "published").iterdir())) <= 3


def test_a_failing_compaction_does_not_deny_the_layers(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(batch_run, "compact_revenue", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, shop(frame), seed(frame), root, "r1", now(), FEW)
    log = read_current(spark, f"{root}/monitoring/pipeline_runs", RUN_LOG)
    assert rows(log, "status", "failed_task") == [("SUCCESS", "compaction")]
    assert rows(read_marts(spark, root)["mart_daily_revenue"], "order_count") == [(1,), (3,)]


def test_a_minute_the_batch_holds_is_not_added_again(spark, frame, tmp_path):
    """The newest payment of the layers is of 10:00:00; a window of that minute is in them, a later one is not."""
    root = str(tmp_path)
    day = F.lit("2024-03-01").cast("date")

    def publish(time, batch):
        after = {"payment_id": 1, "order_id": 1, "amount": 7.0, "payment_status": "success", "paid_at": f"2024-03-01T{time}Z"}
        raw = spark.createDataFrame([(json.dumps({"op": "c", "after": after}),)], "value string")
        live.publish_revenue(live.payment_rows(live.payment_events(raw)), batch, f"{root}/realtime")

    publish("10:00:00", 0)
    run_batch(spark, shop(frame), seed(frame), root, "r1", now(), FEW)
    assert versions.newest(spark, root)["high_water"] == at("2024-03-01 10:00:00").replace(tzinfo=None)
    columns = ("batch_orders", "speed_orders", "merged_orders", "speed_revenue")
    assert rows(merged_today(spark, root, day), *columns) == [(3, 0, 3, 0)]
    publish("10:01:30", 1)
    assert rows(merged_today(spark, root, day), *columns) == [(3, 1, 4, 7)]


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        read_marts(spark, str(tmp_path))


def test_raw_load_replaces_and_counts(spark, frame, tmp_path):
    tables = shop(frame)
    load_raw(tables, str(tmp_path))
    assert load_raw(tables, str(tmp_path)) == FEW
    assert rows(read_layer(spark, str(tmp_path))["order_items"]) == rows(tables["order_items"])


def test_generated_column_is_derived_again(frame):
    items = shop(frame)["order_items"]
    spoiled = items.withColumn("line_total", F.lit(0).cast("decimal(10,2)"))
    assert rows(recompute_generated("order_items", spoiled)) == rows(items)
    assert recompute_generated("order_items", items).columns == items.columns


def test_region_seed_from_csv(spark, tmp_path):
    path = tmp_path / "regions.csv"
    path.write_text("country,region\nKenya,Africa\nNew Zealand,Oceania\n")
    assert rows(read_region_seed(spark, str(path))) == [("Kenya", "Africa"), ("New Zealand", "Oceania")]


def test_key_ranges_follow_the_row_counts(frame):
    counts = frame("low bigint, n bigint", (0, 5), (100, 90), (200, 5), (300, 40), (400, 70))
    assert key_ranges(counts, "id", 100) == [
        "id < 300",
        "id >= 300 AND id < 400",
        "id >= 400",
        "id IS NULL",
    ]
    assert key_ranges(counts.limit(0), "id", 100) == ["id IS NOT NULL", "id IS NULL"]
