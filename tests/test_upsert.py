"""Keyed updates, compaction, the run log and stored tables."""

from __future__ import annotations

import json
import os
import threading
import uuid
from datetime import date
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import upsert
from tallyhouse.plans import batch_run
from tallyhouse.schemas import REVENUE_BY_MINUTE, RUN_LOG
from tests.conftest import at, rows

SCHEMA = "k int, a int, b string"


def test_keyed_upsert_changes_only_listed_columns(frame):
    target = frame(SCHEMA, (1, 10, "x"), (2, 20, "y"))
    updates = frame(SCHEMA, (2, 21, "changed"), (3, 30, "new"))
    assert rows(upsert.keyed_upsert(target, updates, ["k"], ["a"])) == [(1, 10, "x"), (2, 21, "y"), (3, 30, "new")]


def test_keyed_upsert_can_set_null_and_lacks_columns(frame):
    target = frame(SCHEMA, (1, 10, "x"))
    updates = frame("k int, a int", (1, None), (2, 5))
    assert rows(upsert.keyed_upsert(target, updates, ["k"], ["a"])) == [(1, None, "x"), (2, 5, None)]


def test_keyed_upsert_with_two_keys_and_again(frame):
    target = frame("k int, p int, v int", (1, 1, 5))
    updates = frame("k int, p int, v int", (1, 1, 6), (1, 2, 7))
    once = upsert.keyed_upsert(target, updates, ["k", "p"], ["v"])
    assert rows(once) == rows(upsert.keyed_upsert(once, updates, ["k", "p"], ["v"])) == [(1, 1, 6), (1, 2, 7)]


def test_compaction_takes_the_row_ingested_last(frame):
    staging = frame(
        "window_start timestamp, order_count bigint, revenue decimal(22,2), ingested_at timestamp",
        (at("2024-01-01 00:00:00"), 1, Decimal("1.00"), at("2024-01-01 00:01:00")),
        (at("2024-01-01 00:00:00"), 3, Decimal("16.00"), at("2024-01-01 00:02:00")),
        (at("2024-01-01 00:01:00"), 2, Decimal("2.00"), at("2024-01-01 00:02:00")),
    )
    assert rows(upsert.compact_latest(staging), "order_count") == [(2,), (3,)]


def test_ties_go_to_the_greatest_row(frame):
    log = frame("k int, at int, a int, b string", (1, 5, 1, "z"), (1, 5, 2, None), (1, 5, 2, "y"), (1, 4, 9, "x"))
    assert rows(upsert.latest_per_key(log, ["k"], ["at"])) == [(1, 5, 2, "y")]


def test_statement_without_columns_to_change():
    assert upsert.upsert_statement("t", ["k"], ["k"], []).endswith('ON CONFLICT ("k") DO NOTHING')


def test_run_log_keeps_the_first_start(spark, tmp_path):
    path = str(tmp_path / "runs")
    batch_run.log_run(spark, path, "r1", "hourly", at("2024-01-01 00:00:00"), "checks")
    batch_run.log_run(spark, path, "r1", "renamed", at("2024-01-01 05:00:00"), None)
    batch_run.log_run(spark, path, "r2", "hourly", at("2024-01-01 01:00:00"), "models")
    log = upsert.read_current(spark, path, RUN_LOG)
    assert rows(log, "run_id", "dag_id", "status", "failed_task") == [
        ("r1", "hourly", "SUCCESS", None),
        ("r2", "hourly", "FAILED", "models"),
    ]
    first = log.filter("run_id = 'r1'").select(F.date_format("started_at", "HH:mm")).first()[0]
    assert first == "00:00"


def window(minute, count, day=1):
    return (at(f"2024-01-{day:02d} 00:{minute:02d}:00"), count, Decimal(count), at("2024-02-01 00:00:00"))


def test_window_table_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "revenue_by_minute")

    def put(*values):
        upsert.replace_days(spark.createDataFrame(list(values), REVENUE_BY_MINUTE), path, REVENUE_BY_MINUTE)

    def counts(days=None):
        return rows(upsert.read_days(spark, path, REVENUE_BY_MINUTE, days), "order_count")

    def folder(day):
        return {r["window_date"]: r["folder"] for r in upsert.read_current(spark, f"{path}/days", upsert.DAYS).collect()}[date(2024, 1, day)]

    put(window(0, 1, day=1), window(0, 5, day=2))
    untouched = folder(1)
    put(window(0, 6, day=2), window(1, 7, day=2), window(0, 9, day=3))
    assert folder(1) == untouched and counts() == [(1,), (6,), (7,), (9,)]
    assert counts([date(2024, 1, 2)]) == [(6,), (7,)] and counts([date(2024, 1, 9)]) == []
    for k in range(4):
        put(window(0, 10 + k, day=2))
    assert sorted(counts()) == [(1,), (9,), (13,)]
    # What no kept version of the table of days names is gone.
    assert len(list((tmp_path / "revenue_by_minute" / "data").rglob("window_date=2024-01-02"))) <= upsert.KEPT_VERSIONS


def test_a_replacement_that_is_cut_off_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "windows")
    old = spark.createDataFrame([window(0, 1)], REVENUE_BY_MINUTE)
    new = spark.createDataFrame([window(0, 2)], REVENUE_BY_MINUTE)
    upsert.replace_days(old, path, REVENUE_BY_MINUTE)
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "replace_table", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert.replace_days(new, path, REVENUE_BY_MINUTE)
    assert rows(upsert.read_days(spark, path, REVENUE_BY_MINUTE), "order_count") == [(1,)]
    upsert.replace_days(new, path, REVENUE_BY_MINUTE)
    assert rows(upsert.read_days(spark, path, REVENUE_BY_MINUTE), "order_count") == [(2,)]


def test_readers_see_one_version_during_replacements(spark, tmp_path):
    """A reader in the middle of writes sees whole versions."""
    path, schema = str(tmp_path / "small"), spark.range(1).schema
    upsert.replace_table(spark.range(1000), path, schema)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(upsert.read_current(spark, path, schema).agg(F.count("id"), F.max("id")).first())

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 6):
        upsert.replace_table(spark.range(1000 * k, 1000 * k + 1000).toDF("id"), path, schema)
    stop.set()
    reader.join()
    assert seen and {n for n, _ in seen} == {1000} and {(top + 1) % 1000 for _, top in seen} == {0}
    # A write without its success file is no version.
    os.makedirs(tmp_path / "small" / "999999999999-x")
    assert upsert.read_current(spark, path, schema).agg(F.max("id")).first()[0] == 5999
    upsert.replace_table(upsert.read_current(spark, path, schema).filter("id < 5500"), path, schema)
    assert upsert.read_current(spark, path, schema).count() == 500


class RecordingConnection:
    """Stands in for a database: every batch of rows becomes one file."""

    def __init__(self, folder):
        self.folder = folder
        self.pending = []

    def cursor(self):
        return self

    def executemany(self, statement, values):
        self.pending.append({"statement": statement, "rows": [list(v) for v in values]})

    def commit(self):
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as out:
            json.dump(self.pending, out)

    def rollback(self):
        self.pending = []

    def close(self):
        pass


class FailingConnection(RecordingConnection):
    def executemany(self, statement, values):
        raise ValueError("refused")


def test_relational_upsert_sends_batches_from_the_tasks(spark, tmp_path):
    frame = spark.range(2_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(2)
    upsert.upsert_jdbc(frame, partial(RecordingConnection, str(tmp_path)), "t", ["k"], ["v"])
    batches = [b for name in os.listdir(tmp_path) for b in json.load(open(tmp_path / name))]
    assert sorted(row[0] for b in batches for row in b["rows"]) == list(range(2_500))
    assert max(len(b["rows"]) for b in batches) <= upsert.UPSERT_BATCH
    assert {b["statement"] for b in batches} == {
        'INSERT INTO t ("k", "v") VALUES (%s, %s) ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"'
    }


def test_relational_upsert_reports_errors(spark, tmp_path):
    with pytest.raises(Exception, match="refused"):
        upsert.upsert_jdbc(spark.range(1).toDF("k"), partial(FailingConnection, str(tmp_path)), "t", ["k"], [])
    assert os.listdir(tmp_path) == []
