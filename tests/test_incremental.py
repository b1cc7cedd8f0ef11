"""Incremental refreshes against a full run on the same tables."""

from __future__ import annotations

import os
import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import incremental, versions
from tallyhouse.plans.warehouse import Warehouse
from tests.conftest import at, rows, seed, shop

COMPARED = ("dim_customers", "dim_products", "fact_orders", "mart_daily_revenue", "mart_top_products", "mart_customer_metrics")


def refresh(spark, frame, root, run, **changes):
    incremental.refresh(spark, root, run, changes, seed(frame))


def numbers(table):
    """Rows with columns in one order and all decimals of one scale."""
    names = sorted(table.columns)
    exact = [F.col(f.name).cast("decimal(30,4)") if f.dataType.simpleString().startswith("decimal") else F.col(f.name) for f in table.select(*names).schema]
    return rows(table.select(*exact))


def same_as_full(spark, frame, root, tables):
    full = Warehouse(tables, lambda: seed(frame))
    for name in COMPARED:
        assert numbers(incremental.read_table(spark, root, name)) == numbers(full[name]), name


def test_inserts_updates_moves_and_deletions(spark, frame, tmp_path):
    root, tables = str(tmp_path), shop(frame)
    refresh(spark, frame, root, "r1", **tables)
    same_as_full(spark, frame, root, tables)
    day, order, item = at("2024-04-09 08:00:00"), tables["orders"], tables["order_items"]

    # A cancelled order, one moved to another month, one of another customer, a new one, and an item moved to another order.
    new_orders = frame(
        order.schema.simpleString()[7:-1].replace(":", " "),
        (1, 1, "Cancelled", at("2024-03-01 10:00:00"), day, day),
        (2, 1, "shipped", day, day, day),
        (4, 3, "placed", at("2024-03-02 23:59:59"), day, day),
        (9, 3, "paid", day, day, day),
    )
    new_items = frame(
        item.schema.simpleString()[7:-1].replace(":", " "),
        (4, 9, 2, 3, Decimal("100.00"), Decimal("300.00"), day),
        (6, 9, 3, 1, Decimal("5.00"), Decimal("5.00"), day),
    )
    gone = frame("order_item_id bigint, _deleted boolean", (5, True))
    deleted = item.join(gone, "order_item_id").select(*item.columns, "_deleted")
    refresh(
        spark, frame, root, "r2", orders=new_orders,
        order_items=new_items.withColumn("_deleted", F.lit(None).cast("boolean")).unionByName(deleted),
    )
    tables["orders"] = order.join(new_orders, "order_id", "left_anti").unionByName(new_orders)
    tables["order_items"] = (
        item.join(new_items, "order_item_id", "left_anti").join(gone, "order_item_id", "left_anti").unionByName(new_items)
    )
    same_as_full(spark, frame, root, tables)

    # Another name of a customer and of a product; a payment; an order that goes with its item left behind.
    people = tables["customers"].filter("customer_id = 3").withColumns({"full_name": F.lit("Cyd"), "country": F.lit("Japan")})
    goods = tables["products"].filter("product_id = 2").withColumn("product_name", F.lit("Table"))
    paid = tables["payments"].filter("payment_id = 4").withColumns({"payment_status": F.lit("success"), "paid_at": F.lit(day)})
    lost = tables["orders"].filter("order_id = 2").withColumn("_deleted", F.lit(True))
    refresh(spark, frame, root, "r3", customers=people, products=goods, payments=paid, orders=lost)
    for name, key, change in (("customers", "customer_id", people), ("products", "product_id", goods), ("payments", "payment_id", paid)):
        tables[name] = tables[name].join(change, key, "left_anti").unionByName(change)
    tables["orders"] = tables["orders"].filter("order_id <> 2")
    same_as_full(spark, frame, root, tables)

    # The order comes back and finds its item.
    back = order.filter("order_id = 2")
    refresh(spark, frame, root, "r4", orders=back)
    tables["orders"] = tables["orders"].unionByName(back)
    same_as_full(spark, frame, root, tables)


def test_only_touched_months_are_written(spark, frame, tmp_path):
    root, tables = str(tmp_path), shop(frame)
    later = at("2024-05-02 00:00:00")
    refresh(spark, frame, root, "r1", **tables)
    more = frame(tables["orders"].schema.simpleString()[7:-1].replace(":", " "), (7, 2, "paid", later, later, later))
    refresh(spark, frame, root, "r2", orders=more)
    runs = versions.published(spark, root)
    old, new = (incremental.read_manifest(spark, run["folder"]) for run in (runs[1], runs[0]))
    for name in ("orders", "order_items", "payments", "fact_orders", "mart_daily_revenue", "sales_by_day"):
        assert new[name]["2024-03"] == old[name]["2024-03"], name
    assert new["orders"]["2024-05"].startswith(runs[0]["folder"])
    assert new["products"] == old["products"] and new["customers"] == old["customers"]
    # A year of runs later the unchanged month is still where it was, and nothing unread is kept.
    for k in range(3):
        refresh(spark, frame, root, f"r{3 + k}", orders=more.withColumn("customer_id", F.lit(k).cast("bigint")))
    newest = incremental.read_manifest(spark, versions.current(spark, root))
    assert newest["orders"]["2024-03"] == old["orders"]["2024-03"]
    folders = [os.path.join(d, n) for d, names, _ in os.walk(f"{root}/versions") for n in names if n.startswith("_part=2024-05")]
    assert len([f for f in folders if "/orders/" in f]) == 2
    assert rows(incremental.read_table(spark, root, "mart_daily_revenue"), "order_date", "order_count")[-1] == (date(2024, 5, 2), 1)


def test_a_run_that_fails_changes_nothing(spark, frame, tmp_path, monkeypatch):
    root, tables = str(tmp_path), shop(frame)
    refresh(spark, frame, root, "r1", **tables)
    before = {name: numbers(incremental.read_table(spark, root, name)) for name in COMPARED}
    with monkeypatch.context() as patch:
        patch.setattr(incremental.Refresh, "_customers", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(spark, frame, root, "r2", orders=tables["orders"].withColumn("order_status", F.lit("Cancelled")))
    assert {name: numbers(incremental.read_table(spark, root, name)) for name in COMPARED} == before
    assert [p.name.split("-")[0] for p in (tmp_path / "versions").iterdir()] == ["r1"]


def test_first_run_needs_all_tables_and_empty_ones_do(spark, frame, tmp_path):
    tables = shop(frame)
    with pytest.raises(ValueError, match="payments"):
        refresh(spark, frame, str(tmp_path), "r1", **{n: t for n, t in tables.items() if n != "payments"})
    empty = {name: table.limit(0) for name, table in tables.items()}
    refresh(spark, frame, str(tmp_path), "r1", **empty)
    refresh(spark, frame, str(tmp_path), "r2", orders=tables["orders"], customers=tables["customers"])
    same_as_full(spark, frame, str(tmp_path), {**empty, "orders": tables["orders"], "customers": tables["customers"]})


def test_changes_since_a_moment(frame):
    raw = shop(frame)
    late = {n: f.count() for n, f in incremental.changes_since(raw, F.lit("2024-03-01 09:00:00").cast("timestamp")).items()}
    assert late == {"customers": 3, "products": 3, "orders": 4, "order_items": 5, "payments": 4}
    assert not any(f.count() for f in incremental.changes_since(raw, F.lit("2024-03-01 10:00:00").cast("timestamp")).values())


def test_rows_of_orders_are_joined_once_and_written_once(spark, frame, tmp_path, monkeypatch):
    """With tables too large to broadcast, items and payments meet the changed keys once and their orders once."""
    written, wide = [], {"order_items": 0, "payments": 0}
    kept, write = incremental.Refresh.kept, incremental.Refresh.write

    def seen(how, self, name, frame, *args):
        written.append(name)
        for table in wide:
            if name.endswith(table) and not name.startswith("changed"):
                text = frame._jdf.queryExecution().executedPlan().toString()
                wide[table] += len(re.findall("Exchange hashpartitioning", text))
        return how(self, name, frame, *args)

    root, tables = str(tmp_path), shop(frame)
    refresh(spark, frame, root, "r1", **tables)
    tables["payments"] = tables["payments"].withColumn("payment_status", F.lit("success"))
    tables["order_items"] = tables["order_items"].withColumn("quantity", F.col("quantity") + 1)
    monkeypatch.setattr(incremental.Refresh, "kept", lambda *args: seen(kept, *args))
    monkeypatch.setattr(incremental.Refresh, "write", lambda *args: seen(write, *args))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        refresh(spark, frame, root, "r2", payments=tables["payments"], order_items=tables["order_items"])
    finally:
        for key in keys:
            spark.conf.unset(key)
    # Rows and changes by key; rows, touched orders and their months by order.
    assert wide == {"order_items": 5, "payments": 5}
    assert [name for name in written if name.endswith(("order_items", "payments"))].count("order_items") == 1
    assert not {"old_order_items", "new_order_items", "old_payments", "new_payments"} & set(written)
    same_as_full(spark, frame, root, tables)


def most_broadcast_rows(spark, after):
    """The largest number of rows broadcast in executions that began after one; the ids of executions are numbers."""
    store, most = spark._jsparkSession.sharedState().statusStore(), 0
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    for i in range(runs.size()):
        run = runs.apply(i).executionId()
        if run <= after:
            continue
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for node in (nodes.apply(k) for k in range(nodes.size())):
            if node.name() == "BroadcastExchange":
                counted = [node.metrics().apply(k) for k in range(node.metrics().size())]
                shown = [values.get(m.accumulatorId()) for m in counted if m.name() == "number of output rows"]
                most = max([most, *[int(v.get().replace(",", "")) for v in shown if v.isDefined()]])
    return most


def test_keys_are_broadcast_by_their_number_not_by_their_files(spark, frame, tmp_path):
    """The ids of many customers are a few compressed kilobytes, of which a driver makes a large hash table."""
    root, tables, many = str(tmp_path), shop(frame), 3_000
    first = tables["customers"].filter("customer_id = 1").drop("customer_id")
    tables["customers"] = spark.range(1, many + 1).withColumnRenamed("id", "customer_id").crossJoin(F.broadcast(first)).select(tables["customers"].columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        refresh(spark, frame, root, "r1", **tables)
        runs = spark._jsparkSession.sharedState().statusStore().executionsList()
        before = max(runs.apply(i).executionId() for i in range(runs.size()))
        tables["customers"] = tables["customers"].withColumn("full_name", F.lit("Zoe"))
        refresh(spark, frame, root, "r2", customers=tables["customers"])
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Few keys are still broadcast, so stored tables need no shuffle to meet them.
    assert 0 < most_broadcast_rows(spark, before) < many
    assert threshold == "20k"
    same_as_full(spark, frame, root, tables)
