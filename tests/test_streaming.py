"""Change streams from files, one file per trigger, against the batch answer on the same events."""

from __future__ import annotations

import json
import os
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import realtime
from tallyhouse.plans import batch_run
from tallyhouse.schemas import ORDER_ITEM_ROW, PAYMENT_ROW
from tallyhouse.sources.cdc import created_items, parse_changes, successful_payments
from tallyhouse.streaming import durable, live
from tests.conftest import at, rows

ONCE = {"availableNow": True}
NOW = "2024-01-01 09:00:00"


def payment(pid, order, amount, time, op="c", status="success"):
    stamp = None if time is None else f"2024-01-01T{time}Z"
    after = {"payment_id": pid, "order_id": order, "amount": amount, "payment_status": status, "paid_at": stamp}
    return json.dumps({"before": None, "after": after, "op": op, "ts_ms": 1704067210000})


def item(product, quantity, price, total, time, op="c"):
    stamp = None if time is None else f"2024-01-01T{time}Z"
    after = {"order_item_id": 1, "order_id": 1, "product_id": product, "quantity": quantity, "unit_price": price}
    return json.dumps({"after": {**after, "line_total": total, "created_at": stamp}, "op": op})


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of text files as a change stream, one file per trigger."""
    folder = tmp_path / "topic"
    folder.mkdir()
    count = [0]

    def send(*lines):
        count[0] += 1
        path = folder / f"{count[0]:04d}.txt"
        path.write_text("\n".join(lines))
        # The source takes files in the order of their times.
        os.utime(path, (1_700_000_000 + count[0], 1_700_000_000 + count[0]))

    def stream():
        return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))

    def static():
        return spark.read.text(str(folder))

    topic.send, topic.stream, topic.static = send, stream, static
    return topic


def run_revenue(topic, tmp_path):
    now = F.lit(NOW).cast("timestamp")
    live.start_revenue(topic.stream(), str(tmp_path / "rt"), str(tmp_path / "ck"), ONCE, now).awaitTermination()


def published(spark, tmp_path):
    return rows(live.read_revenue_windows(spark, str(tmp_path / "rt")), "window_start", "order_count", "revenue")


def batch_answer(topic):
    now = F.lit(NOW).cast("timestamp")
    payments = successful_payments(parse_changes(topic.static(), PAYMENT_ROW), now)
    return rows(realtime.revenue_by_minute(realtime.with_window(payments, "1 minute")))


def minute(text):
    return at(f"2024-01-01 {text}:00").replace(tzinfo=None)


def test_filters_and_defaults(spark, topic):
    topic.send(
        payment(1, 1, 1.0, "00:00:10"),
        payment(2, 2, 2.0, "00:00:20", op="u"),
        payment(3, 3, 3.0, "00:00:30", op="d"),
        payment(4, 4, 4.0, "00:00:30", op="r"),
        payment(5, 5, 5.0, "00:00:30", status="Success"),
        payment(6, 6, None, None),
        "this is no json",
        "",
        '{"op": "c"}',
    )
    now = F.lit(NOW).cast("timestamp")
    got = rows(successful_payments(parse_changes(topic.static(), PAYMENT_ROW), now), "payment_id", "amount", "event_time")
    assert got == [
        (1, 1.0, minute("00:00") + timedelta(seconds=10)),
        (2, 2.0, minute("00:00") + timedelta(seconds=20)),
        (6, 0.0, minute("09:00")),
    ]


def test_unreadable_time_counts_at_processing_time(spark, topic):
    topic.send('{"after": {"payment_id": 1, "payment_status": "success", "paid_at": "yesterday"}, "op": "c"}')
    now = F.lit(NOW).cast("timestamp")
    assert rows(successful_payments(parse_changes(topic.static(), PAYMENT_ROW), now), "event_time") == [(minute("09:00"),)]


def test_window_over_several_triggers_has_its_full_total(spark, topic, tmp_path):
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    topic.send(payment(2, 2, 5.0, "00:00:40"), payment(3, 1, 0.5, "00:00:41"))
    topic.send(payment(4, 3, 0.5, "00:00:59"), payment(5, 3, 0.25, "00:01:00"))
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == [
        (minute("00:00"), 3, Decimal("16.00")),
        (minute("00:01"), 1, Decimal("0.25")),
    ]
    assert published(spark, tmp_path) == batch_answer(topic)
    root = str(tmp_path / "rt")
    assert rows(live.read_latest_revenue(spark, root)) == [(minute("00:01"), 1, Decimal("0.25"))]
    assert rows(live.read_kept_revenue(spark, root)) == [(minute("00:01"), 1, Decimal("0.25"))]
    assert [r.order_count for r in live.read_revenue_series(spark, root).collect()] == [1, 3]


def fates(spark, tmp_path, kind="payments"):
    """(events, rejected, late, published) of all micro-batches."""
    counts = live.read_accounts(spark, str(tmp_path / "rt"), kind)
    return tuple(counts.agg(*[F.sum(c) for c in ("events", "rejected", "late", "published")]).first())


def test_late_events_are_set_aside_and_accounted_for(spark, topic, tmp_path):
    """A window stays open until a trigger has begun with a watermark behind it; nothing is lost without a row."""
    root = str(tmp_path / "rt")
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    topic.send(payment(2, 2, 1.0, "05:00:00"))
    topic.send(payment(3, 3, 2.0, "00:00:20"))
    topic.send(payment(4, 4, 4.0, "00:00:30"), payment(5, 5, 1e20, "00:00:40"), payment(6, 6, 1.0, "05:00:10"))
    topic.send(payment(7, 7, 4.0, "00:00:50"))
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == [
        (minute("00:00"), 2, Decimal("12.00")),
        (minute("05:00"), 2, Decimal("2.00")),
    ]
    assert rows(live.read_set_aside(spark, root, "late", "payments"), "payment_id", "batch_id") == [(4, 3), (7, 4)]
    assert rows(live.read_set_aside(spark, root, "rejected", "payments"), "payment_id") == [(5,)]
    assert fates(spark, tmp_path) == (7, 1, 2, 4)
    log = live.overlaid(live.read_compacted_revenue(spark, root), live.read_revenue_staging(spark, root))
    assert rows(live.newest_totals(log, ["bucket"]).agg(F.sum("events"))) == [(4,)]
    batch_run.compact_revenue(spark, root)
    assert fates(spark, tmp_path) == (7, 1, 2, 4) and live.read_new_accounts(spark, root, "payments").isEmpty()


def test_restart_goes_on_from_the_checkpoint(spark, topic, tmp_path):
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    run_revenue(topic, tmp_path)
    topic.send(payment(2, 2, 5.0, "00:00:20"))
    run_revenue(topic, tmp_path)
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == [(minute("00:00"), 2, Decimal("15.00"))]


def test_replayed_batch_replaces_itself(spark, topic, tmp_path, monkeypatch):
    """A micro-batch that has published and then fails is run again from the state of the one before."""
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    run_revenue(topic, tmp_path)
    topic.send(payment(2, 2, 5.0, "00:00:20"), payment(3, 3, 1e20, "00:00:20"))
    publish = live.publish_revenue

    def publish_and_fail(*args):
        publish(*args)
        raise ValueError("lost")

    for _ in range(2):
        with monkeypatch.context() as patch:
            patch.setattr(live, "publish_revenue", publish_and_fail)
            with pytest.raises(Exception, match="lost"):
                run_revenue(topic, tmp_path)
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == [(minute("00:00"), 2, Decimal("15.00"))]
    assert fates(spark, tmp_path) == (3, 1, 0, 2)


def test_batches_without_payments_publish_nothing(spark, topic, tmp_path):
    topic.send(payment(1, 1, 10.0, "00:00:10", status="failed"))
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == []


def test_compaction_between_batches(spark, topic, tmp_path):
    root = str(tmp_path / "rt")
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    run_revenue(topic, tmp_path)
    batch_run.compact_revenue(spark, root)
    assert live.read_revenue_staging(spark, root).isEmpty()
    assert published(spark, tmp_path) == batch_answer(topic)
    topic.send(payment(2, 2, 5.0, "00:00:20"), payment(3, 3, 5.0, "00:07:20"))
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == batch_answer(topic)
    batch_run.compact_revenue(spark, root)
    batch_run.compact_revenue(spark, root)
    assert published(spark, tmp_path) == batch_answer(topic)


def test_top_products(spark, frame, topic, tmp_path):
    products = frame("product_id bigint, product_name string", (1, "Lamp"))
    topic.send(
        item(1, 2, 3.0, 6.0, "00:01:00"),
        item(1, 2, 3.0, None, "00:02:00"),
        item(2, 1, None, None, "00:03:00"),
        item(1, None, 3.0, None, "00:04:00"),
        item(1, 9, 9.0, 81.0, "00:04:00", op="u"),
        item(1, 9, 9.0, 81.0, None),
    )
    topic.send(item(1, 1, 3.0, 3.0, "00:04:59"), item(1, 1, 3.0, 3.0, "00:05:00"))
    root = str(tmp_path / "rt")
    live.start_top_products(topic.stream(), products, root, str(tmp_path / "ck"), ONCE).awaitTermination()
    expected = [
        (minute("00:00"), 1, "Lamp", 5, Decimal("15.00")),
        (minute("00:00"), 2, None, 1, Decimal("0.00")),
        (minute("00:05"), 1, "Lamp", 1, Decimal("3.00")),
    ]
    columns = ("window_start", "product_id", "product_name", "units_sold", "revenue")
    assert rows(live.read_product_windows(spark, root), *columns) == expected
    batch = realtime.with_window(created_items(parse_changes(topic.static(), ORDER_ITEM_ROW)), "5 minutes")
    assert rows(realtime.top_products_5min(batch, products), *columns) == expected
    shown = [tuple(r) for r in live.read_top_products(spark, root).collect()]
    assert shown == [("Lamp", Decimal("3.00"))]
    batch_run.compact_top_products(spark, root)
    assert [tuple(r) for r in live.read_top_products(spark, root).collect()] == shown
    assert live.read_product_staging(spark, root).isEmpty()
    assert rows(live.read_product_windows(spark, root), *columns) == expected


def test_closed_windows_are_exact_and_published_once(spark, topic, tmp_path):
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    topic.send(payment(2, 2, 5.0, "00:00:40"), payment(2, 2, 5.0, "00:00:40"), payment(3, 2, 4.0, "00:00:45"))
    topic.send(payment(1, 1, 10.0, "00:00:10"), payment(9, 9, 1.0, "00:10:30"))
    topic.send(payment(10, 10, 2.0, "00:20:50"))
    topic.send(payment(11, 11, 2.0, "00:30:50"))
    payments = successful_payments(parse_changes(topic.stream(), PAYMENT_ROW))
    path = str(tmp_path / "closed")
    durable.start_closed_revenue(payments, path, str(tmp_path / "ck"), ONCE).awaitTermination()
    assert rows(spark.read.parquet(path)) == [
        (minute("00:00"), 2, Decimal("19.00")),
        (minute("00:10"), 1, Decimal("1.00")),
        (minute("00:20"), 1, Decimal("2.00")),
    ]


def test_join_of_stream_and_table(spark, frame, topic, tmp_path):
    products = frame("product_id bigint, product_name string", (1, "Lamp"))
    topic.send(item(1, 1, 1.0, 1.0, "00:00:00"), item(8, 1, 1.0, 1.0, "00:00:00"))
    named = realtime.with_product_names(live.item_events(topic.stream()), products)
    query = (
        named.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "product_id", "product_name") == [(1, "Lamp"), (8, None)]


def test_new_checkpoint_starts_a_generation(spark, topic, tmp_path):
    """Two files under one checkpoint; under a new one on the same root all of them again, in other micro-batches."""
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    topic.send(payment(2, 2, 5.0, "00:00:20"))
    run_revenue(topic, tmp_path)
    topic.send(payment(3, 3, 0.75, "00:00:30"))
    root, now = str(tmp_path / "rt"), F.lit(NOW).cast("timestamp")
    folder = str(tmp_path / "topic")
    anew = spark.readStream.option("maxFilesPerTrigger", 3).text(folder)
    live.start_revenue(anew, root, str(tmp_path / "ck2"), ONCE, now).awaitTermination()
    topic.send(payment(4, 4, 0.25, "00:00:40"))
    live.start_revenue(anew, root, str(tmp_path / "ck2"), ONCE, now).awaitTermination()
    assert published(spark, tmp_path) == [(minute("00:00"), 4, Decimal("16.00"))]
    batch_run.compact_revenue(spark, root)
    assert published(spark, tmp_path) == [(minute("00:00"), 4, Decimal("16.00"))]


def test_bad_money_is_rejected_and_stops_nothing(spark, frame, topic, tmp_path):
    topic.send(payment(1, 1, 1e20, "00:00:10"), payment(2, 2, 5.0, "00:00:20"))
    run_revenue(topic, tmp_path)
    root = str(tmp_path / "rt")
    assert published(spark, tmp_path) == [(minute("00:00"), 1, Decimal("5.00"))]
    assert fates(spark, tmp_path) == (2, 1, 0, 1)
    products = frame("product_id bigint, product_name string", (1, "Lamp"))
    lines = [item(1, 1, 1e20, None, "00:01:00"), item(1, 1, 2.0, 1e30, "00:01:00"), item(1, 2, 2.0, None, "00:01:00")]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    live.publish_top_products(live.item_rows(live.item_events(raw)), 0, root, products)
    assert rows(live.read_product_windows(spark, root), "units_sold", "revenue") == [(2, Decimal("4.00"))]
    assert fates(spark, tmp_path, "items") == (3, 2, 0, 1)


def test_payments_without_an_id_are_not_copies(spark, topic, tmp_path):
    topic.send(payment(None, 1, 2.0, "00:00:10"), payment(None, 2, 3.0, "00:00:20"), payment(7, 3, 2.0, "00:00:30"))
    topic.send(payment(8, 8, 1.0, "00:20:30"))
    topic.send(payment(9, 9, 1.0, "00:30:30"))
    payments = successful_payments(parse_changes(topic.stream(), PAYMENT_ROW))
    path = str(tmp_path / "closed")
    durable.start_closed_revenue(payments, path, str(tmp_path / "ck"), ONCE).awaitTermination()
    assert rows(spark.read.parquet(path))[0] == (minute("00:00"), 3, Decimal("7.00"))


def test_published_rows_do_not_grow_with_the_payments(spark, topic, tmp_path):
    root = str(tmp_path / "rt")
    topic.send(*[payment(i, i % 3_000, 1.0, "00:00:10") for i in range(30)])
    topic.send(*[payment(i, i % 3_000, 1.0, "00:00:20") for i in range(6_000)])
    run_revenue(topic, tmp_path)
    staged = live.read_revenue_staging(spark, root).groupBy("batch_id").count()
    # Ids from 0 to 2,999 lie in two ranges of ids: 0 and below, and 1 to 32,768.
    assert rows(staged) == [(0, 2), (1, 2)]
    assert published(spark, tmp_path) == [(minute("00:00"), 3_000, Decimal("6030.00"))]


def test_orders_are_counted_once_whatever_their_ids(spark, topic, tmp_path):
    ids = [None, None, 0, -1, -1, 1, 32_768, 32_769, 32_769, 1 << 40, -(1 << 40)]
    topic.send(*[payment(i, order, 1.0, "00:00:10") for i, order in enumerate(ids)])
    topic.send(*[payment(i, order, 1.0, "00:00:20") for i, order in enumerate(reversed(ids))], payment(99, 5, 1.0, "00:00:30"))
    run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == [(minute("00:00"), 8, Decimal("23.00"))] == batch_answer(topic)


def test_a_trigger_opens_no_file_of_earlier_ones(spark, frame, topic, tmp_path):
    """All that earlier triggers have staged is made unreadable; the totals of the next one are complete all the same."""
    root = tmp_path / "rt"
    products = frame("product_id bigint, product_name string", (1, "Lamp"))

    def run():
        run_revenue(topic, tmp_path)
        live.start_top_products(topic.stream(), products, str(root), str(tmp_path / "ck"), ONCE).awaitTermination()

    topic.send(payment(1, 1, 10.0, "00:00:10"), item(1, 1, 1.0, 1.0, "00:00:30"))
    run()
    for path in root.rglob("*.parquet"):
        if "staging" in str(path):
            path.write_bytes(b"no parquet")
    topic.send(payment(2, 2, 5.0, "00:00:20"), item(1, 1, 1.0, 2.0, "00:00:40"))
    run()
    for path in list(root.rglob("*.parquet")):
        if path.read_bytes() == b"no parquet":
            path.unlink()
            path.with_name(f".{path.name}.crc").unlink()
    assert published(spark, tmp_path) == [(minute("00:00"), 2, Decimal("15.00"))]
    assert rows(live.read_product_windows(spark, str(root)), "units_sold", "revenue") == [(2, Decimal("3.00"))]


def test_state_is_dropped_behind_the_watermark(spark, topic, tmp_path):
    """However many hours have gone by, the state holds the windows of the last two minutes."""
    kept = []
    for hour in range(4):
        topic.send(*[payment(1000 * hour + i, i, 1.0, f"{hour:02d}:{i:02d}:30") for i in range(60)])
    now = F.lit(NOW).cast("timestamp")
    query = live.start_revenue(topic.stream(), str(tmp_path / "rt"), str(tmp_path / "ck"), ONCE, now)
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept[-1] <= 4 and max(kept) <= 2 * 60 + 4
    assert [r[2] for r in published(spark, tmp_path)] == [Decimal("1.00")] * 240


def test_restart_with_new_files_goes_on_with_the_state(spark, topic, tmp_path):
    for k in range(3):
        topic.send(payment(k, k, 1.0, f"00:00:1{k}"), payment(10 + k, 50, 1.0, "00:01:05"))
        run_revenue(topic, tmp_path)
    assert published(spark, tmp_path) == [(minute("00:00"), 3, Decimal("3.00")), (minute("00:01"), 1, Decimal("3.00"))]


class Query:
    """Stands in for a streaming query that ends after some polls, with or without an error."""

    def __init__(self, name, polls, error=None):
        self.name, self.polls, self.error, self.isActive, self.stopped = name, polls, error, True, False

    def awaitTermination(self, timeout):
        self.polls -= 1
        if self.polls < 0:
            self.isActive = False
            if self.error:
                raise self.error

    def stop(self):
        self.isActive, self.stopped = False, True


def test_the_end_of_one_stream_stops_the_other():
    one, two = Query("one", 3), Query("two", 1000)
    with pytest.raises(live.StreamEnded, match="one has ended"):
        live.supervise([one, two], ends=False)
    assert two.stopped and not one.stopped
    for ends in (True, False):
        one, two = Query("one", 1000), Query("two", 3, ValueError("no more disk"))
        with pytest.raises(live.StreamEnded, match="two has failed: no more disk"):
            live.supervise([one, two], ends)
        assert one.stopped
    one, two = Query("one", 1), Query("two", 5)
    live.supervise([one, two], ends=True)
    assert not one.stopped and not two.stopped and two.polls < 0


def test_a_failing_stream_stops_the_speed_layer(spark, frame, topic, tmp_path, monkeypatch):
    products = frame("product_id bigint, product_name string", (1, "Lamp"))
    topic.send(payment(1, 1, 10.0, "00:00:10"), item(1, 1, 1.0, 1.0, "00:00:30"))

    def fail(*args):
        raise ValueError("no such table")

    monkeypatch.setattr(live, "publish_top_products", fail)
    root, often = str(tmp_path / "rt"), {"processingTime": "100 milliseconds"}
    with pytest.raises(live.StreamEnded, match="(?s)top_products_5min has failed: .*no such table"):
        live.run_speed_layer(spark, topic.stream(), topic.stream(), products, root, str(tmp_path / "ck"), often)
    assert not spark.streams.active


def test_both_streams_and_the_kept_list(spark, frame, topic, tmp_path):
    products = frame("product_id bigint, product_name string", *[(i, f"p{i}") for i in range(30)])
    topic.send(*[item(i, 1, float(i), float(i), "00:01:00") for i in range(25)], payment(1, 1, 3.0, "00:00:10"))
    topic.send(*[item(i, 1, 1.0, 1.0, "00:06:00") for i in range(3)])
    topic.send(item(29, 1, 99.0, 99.0, "00:02:00"))
    root = str(tmp_path / "rt")
    live.run_speed_layer(spark, topic.stream(), topic.stream(), products, root, str(tmp_path / "ck"), ONCE)
    # The last file's late window does not replace the newer one.
    assert rows(live.read_live_list(spark, root), "window_start", "product_id") == [(minute("00:05"), i) for i in range(3)]
    assert published(spark, tmp_path)[0] == (minute("00:00"), 1, Decimal("3.00"))


def test_each_envelope_is_parsed_once(spark, topic):
    topic.send(payment(1, 1, 10.0, "00:00:10"))
    for events in (live.payment_events(topic.static()), live.item_events(topic.static())):
        plan = events._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_a_stream_makes_the_kept_totals_in_tasks_of_their_own(spark, tmp_path, monkeypatch):
    """Streaming batches run without adaptive execution; one task over all partitions would hold all their sorts."""
    frames = []
    monkeypatch.setattr(live, "replace_table", lambda frame, *_: frames.append(frame))
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    start, end = at("2024-01-01 00:00:00"), at("2024-01-01 00:05:00")
    values = {"window_start": start, "product_id": 1, "product_name": "a", "units_sold": 2, "revenue": Decimal("1.00"), "ingested_at": end}
    values |= {"events": 1, "generation": "g", "batch_id": 0}
    fresh = session.createDataFrame([tuple(values[n] for n in live.PRODUCT_STAGING.names)], live.PRODUCT_STAGING)
    live._keep_newest(fresh, str(tmp_path / "kept"), live.PRODUCT_STAGING, ["product_id"])
    text = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in text and text.lstrip().startswith("Exchange")
    assert [r["product_id"] for r in frames[0].collect()] == [1]
