"""The segment source and tables as of one moment."""

from __future__ import annotations

import json
import shutil

import pytest
from pyspark.sql import functions as F

from tallyhouse.schemas import PAYMENT_ROW
from tallyhouse.sources import changelog, retail, snapshot
from tallyhouse.sources.cdc import parse_changes, parse_images, successful_payments
from tests.conftest import at, rows


def segments(spark, folder, *numbers):
    values = [(n, f"{n}-{k}") for n in numbers for k in range(3)]
    changelog.write_segments(spark.createDataFrame(values, "segment long, value string"), str(folder))


@pytest.fixture
def run(spark, tmp_path):
    """Runs the stream of a folder until it has caught up; the values each micro-batch had, in order."""

    def go(checkpoint="ck", **options):
        seen = {}

        def each(batch, batch_id):
            seen[batch_id] = sorted((r["segment"], r["line"], r["value"]) for r in batch.collect())

        stream = changelog.change_stream(spark, str(tmp_path / "log"), **options)
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / checkpoint)).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return [[s for s, _, _ in seen[k]] for k in sorted(seen) if seen[k]], [v for k in sorted(seen) for v in seen[k]]

    return go


def test_earliest_start_and_bound_per_trigger(spark, tmp_path, run):
    segments(spark, tmp_path / "log", 3, 4, 5, 6, 7)
    batches, values = run(segments_per_trigger=2)
    assert batches == [[3, 3, 3, 4, 4, 4], [5, 5, 5, 6, 6, 6], [7, 7, 7]]
    assert values == [(n, k, f"{n}-{k}") for n in range(3, 8) for k in range(3)]


def test_latest_start(spark, tmp_path, run):
    segments(spark, tmp_path / "log", 0, 1)
    assert run(starting="latest") == ([], [])
    segments(spark, tmp_path / "log", 2)
    assert run(starting="latest")[0] == [[2, 2, 2]]


def test_restart_goes_on_and_keeps_the_bound(spark, tmp_path, run):
    segments(spark, tmp_path / "log", 0, 1, 2)
    assert run(segments_per_trigger=2)[0] == [[0, 0, 0, 1, 1, 1], [2, 2, 2]]
    assert run(segments_per_trigger=2)[0] == []
    segments(spark, tmp_path / "log", 3, 4, 5)
    assert run(segments_per_trigger=2)[0] == [[3, 3, 3, 4, 4, 4], [5, 5, 5]]


def test_a_failed_trigger_is_read_again(spark, tmp_path, run):
    segments(spark, tmp_path / "log", 0, 1)
    stream = changelog.change_stream(spark, str(tmp_path / "log"), segments_per_trigger=1)

    def fail(batch, batch_id):
        if batch_id == 1:
            raise ValueError("lost")

    query = stream.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "ck")).start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    assert run(segments_per_trigger=1)[0] == [[1, 1, 1]]


def test_lost_segments_stop_the_stream_or_are_reported(spark, tmp_path, run):
    segments(spark, tmp_path / "log", 0, 1)
    run()
    segments(spark, tmp_path / "log", 2, 3, 4)
    shutil.rmtree(tmp_path / "log" / "segment=2")
    shutil.rmtree(tmp_path / "log" / "segment=3")
    with pytest.raises(Exception, match="segments 2 to 3 are missing"):
        run()
    batches, values = run(fail_on_data_loss=False)
    assert batches == [[2, 3, 4, 4, 4]]
    assert values[:2] == [(2, changelog.LOST, None), (3, changelog.LOST, None)]


def test_payments_through_the_segments(spark, tmp_path):
    after = {"payment_id": 1, "order_id": 1, "amount": 7.0, "payment_status": "success", "paid_at": "2024-03-02T10:00:30Z"}
    value = json.dumps({"op": "c", "after": after, "note": "é\n🙂"})
    changelog.write_segments(spark.createDataFrame([(0, value)], "segment long, value string"), str(tmp_path / "log"))
    stream = changelog.change_stream(spark, str(tmp_path / "log"))
    payments = successful_payments(parse_changes(stream, PAYMENT_ROW))
    options = {"path": str(tmp_path / "out"), "checkpointLocation": str(tmp_path / "ck")}
    query = payments.writeStream.format("parquet").options(**options).start()
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "payment_id", "amount") == [(1, 7.0)]


def image(id, status):
    return None if status is None else {"id": id, "status": status}


def test_rows_are_rolled_back_to_the_moment(spark, frame):
    """Changes before the moment stay; of several after it the first one counts; unseen changes and deletions too."""
    log = [
        (1, "u", image(1, "a"), image(1, "b"), 10),  # before the moment
        (2, "u", image(2, "a"), image(2, "b"), 101),
        (3, "u", image(2, "b"), image(2, "c"), 101),  # at the same time, later in the log
        (4, "d", image(3, "a"), None, 102),
        (5, "c", None, image(4, "new"), 103),
        (6, "u", image(4, "new"), image(4, "newer"), 104),
        (7, "u", image(5, "a"), image(5, "after the scan"), 500),
        (8, "c", None, image(6, "came and went"), 105),
        (9, "d", image(6, "came and went"), None, 106),
        (10, "d", image(7, "a"), None, 107),
        (11, "c", None, image(7, "again"), 108),
    ]
    values = [(k, json.dumps({"op": op, "before": b, "after": a, "ts_ms": 1_704_067_200_000 + t * 1000})) for k, op, b, a, t in log]
    raw = frame("position long, value string", *values)
    scan = frame("id bigint, status string", (1, "b"), (2, "c"), (4, "newer"), (5, "a"), (7, "again"), (8, "untouched"))
    moment = F.lit(at("2024-01-01 00:01:40"))
    found = snapshot.as_of(scan, parse_images(raw, scan.schema), "id", moment)
    assert rows(found) == [(1, "b"), (2, "a"), (3, "a"), (5, "a"), (7, "a"), (8, "untouched")]
    assert found.columns == scan.columns


def test_layer_as_of_a_moment(spark, frame, tmp_path):
    names = ("customers", "products", "orders", "order_items", "payments")
    scans = {n: frame("id bigint, status string", (1, f"{n} changed")) for n in names}
    value = json.dumps({"op": "u", "before": image(1, "old"), "after": image(1, "new"), "ts_ms": 1_704_067_201_000})
    logs = {"orders": frame("position long, value string", (1, value))}
    layer = snapshot.load_as_of(spark, scans, logs, dict.fromkeys(names, "id"), F.lit(at("2024-01-01 00:00:00")), str(tmp_path))
    assert {n: rows(layer[n], "status") for n in names} == {n: [("old" if n == "orders" else f"{n} changed",)] for n in names}


def test_changes_of_a_table_come_from_one_pass(spark, tmp_path):
    kinds = "order_id bigint, customer_id bigint, order_status string"
    table = spark.createDataFrame([(k, 1, "paid") for k in (10, 14, 3)] + [(None, 1, "paid")], kinds)
    table.write.parquet(str(tmp_path / "orders"))
    table = spark.read.parquet(str(tmp_path / "orders"))
    changes = retail.changes_after("orders", table)
    assert changes._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = sorted((r["position"], r["hour"], r["op"], r["before"] and r["before"]["order_status"], r["after"] and r["after"]["order_id"]) for r in changes.collect())
    assert found == [(-10, 2, "c", None, -10), (-10, 3, "u", "paid", -10), (10, 1, "u", "paid", 10), (10, 3, "u", "returned", 10), (14, 2, "d", "paid", None)]
    assert rows(retail.scanned_after("orders", table, 2), "order_id", "order_status") == sorted(
        [(-10, "paid"), (10, "returned"), (3, "paid"), (None, "paid")], key=repr
    )
