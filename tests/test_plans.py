"""Plans and skew: what must not be shuffled, read or gathered."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import marts, monitoring, orders, quality, realtime, serving, upsert
from tallyhouse.plans.check_suite import bucketed_key_profile, key_profile
from tallyhouse.plans.queries import Inputs, registry
from tallyhouse.session import INITIAL_PARTITIONS, configure, partitions_for
from tallyhouse.sources import retail
from tests.conftest import SMALL, at, rows


@pytest.fixture
def large_tables(spark):
    """Plan as for tables too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_daily_revenue_reads_no_payments_and_shuffles_once_per_table(spark, large_tables):
    text = plan(registry()["mart_daily_revenue"](spark, SMALL))
    assert "customer.parquet" not in text and "o_totalprice" not in text
    assert text.count("Exchange") == 3
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in text


def test_top_products_shuffle_items_once_before_the_roll_up(spark, large_tables):
    text = plan(registry()["mart_top_products"](spark, SMALL))
    assert text.count("Exchange") == 4
    assert text.index("partial_sum") < text.index("SortMergeJoin [order_id")


def test_lookup_filter_reaches_both_scans(spark):
    q = Inputs(spark, SMALL)
    text = plan(serving.product_details(q.warehouse.dim_products, q.raw["order_items"], q.warehouse.order_measures, 7))
    assert "EqualTo(p_partkey,7)" in text and "EqualTo(l_partkey,7)" in text


def test_rank_limit_is_applied_before_the_shuffle(spark, large_tables):
    text = plan(registry()["product_recent_orders"](spark, SMALL))
    final, partial = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert "Exchange hashpartitioning(product_id" in text[final:partial]


def test_long_lists_are_refused(spark):
    q = Inputs(spark, SMALL)
    with pytest.raises(ValueError):
        serving.product_sales_history(q.raw["order_items"], q.warehouse.order_measures, limit=1_001)


def test_top_lists_sort_no_whole_table(spark):
    for name in ("api_daily_revenue", "api_top_products", "api_customer_metrics", "rt_top20"):
        assert "TakeOrderedAndProject" in plan(registry()[name](spark, SMALL))


NO_SINGLE_TASK = ("region_shares", "category_shares", "lambda_today_revenue")


@pytest.mark.parametrize("name", NO_SINGLE_TASK)
def test_no_rows_are_gathered_for_a_window(spark, name):
    text = plan(registry()[name](spark, SMALL))
    assert "Window" not in text.replace("WindowGroupLimit", "").replace("window_start", "")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name, key", [("sink_upsert", "product_id"), ("compact_latest", "")])
def test_newest_rows_are_limited_before_the_shuffle(spark, large_tables, name, key):
    text = plan(registry()[name](spark, SMALL))
    final, partial = text.index("row_number(), 1, Final"), text.rindex("row_number(), 1, Partial")
    assert f"Exchange hashpartitioning({key}" in text[final:partial]


# --- one key with a third of all rows ------------------------------------------------------------

HOT, ROWS = 1, 30_000


@pytest.fixture
def skewed(spark):
    """Items of which a third belong to one order and a third to one product; a third of the orders to one customer."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(HOT)).otherwise(n % 997 + 2)
    items = spark.range(ROWS).select(
        n.alias("order_item_id"),
        key.alias("order_id"),
        F.when(n % 3 == 1, F.lit(HOT)).otherwise(F.hash(n) % 997 + 2000).cast("bigint").alias("product_id"),
        F.lit(1).cast("bigint").alias("quantity"),
        F.lit("0.50").cast("decimal(12,2)").alias("line_total"),
    )
    orders_ = spark.range(1, ROWS + 1).select(
        n.alias("order_id"),
        F.when(n % 3 == 0, F.lit(HOT)).otherwise(n).alias("customer_id"),
        F.when(n % 10 == 9, "cancelled").otherwise("paid").alias("order_status"),
        F.lit("2024-01-01").cast("date").alias("order_date"),
        F.lit("2024-01-01").cast("timestamp").alias("order_ts"),
    )
    payments = spark.range(1, ROWS + 1).select(
        n.alias("order_id"), F.lit("1.00").cast("decimal(12,2)").alias("amount"), F.lit("success").alias("payment_status")
    )
    customers = spark.range(1, ROWS + 1).select(
        n.alias("customer_id"),
        F.lit("n").alias("full_name"),
        F.lit("e").alias("email"),
        F.lit("c").alias("country"),
    )
    return {"items": items, "orders": orders_, "payments": payments, "customers": customers}


@pytest.fixture
def eager_skew_split(spark, large_tables):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_customer_is_split(skewed, eager_skew_split):
    enriched = orders.int_orders_enriched(skewed["orders"], skewed["customers"], skewed["items"], skewed["payments"])
    assert enriched.count() == ROWS
    wide = enriched.select("order_id", "customer_name", "order_value")
    wide.collect()
    assert "SortMergeJoin(skew=true)" in plan(wide)


def test_hot_order_is_split_before_the_roll_up(skewed, eager_skew_split):
    products = skewed["items"].select("product_id", F.lit("p").alias("product_name"), F.lit("c").alias("category")).distinct()
    top = marts.mart_top_products(skewed["items"], products, skewed["orders"])
    got = {r.product_id: r for r in top.collect()}
    assert "SortMergeJoin(skew=true)" in plan(top)
    kept_hot = skewed["items"].filter((F.col("product_id") == HOT) & (F.col("order_id") % 10 != 9)).count()
    assert (got[HOT].units_sold, float(got[HOT].revenue)) == (kept_hot, kept_hot / 2)
    assert sum(r.units_sold for r in got.values()) == skewed["items"].filter("order_id % 10 != 9").count()


def test_hot_keys_shrink_before_any_shuffle(skewed, large_tables):
    """Aggregates send at most one row per key and task, however many rows the key has."""
    checks = {
        "items per order": orders.items_per_order(skewed["items"]),
        "orders per customer": orders.orders_per_customer(
            orders.order_measures(skewed["orders"], skewed["items"], skewed["payments"])
        ),
        "unique": quality.unique(skewed["items"], "order_id"),
        "relationships": quality.relationships(skewed["items"], "order_id", skewed["orders"], "order_id"),
    }
    for name, df in checks.items():
        text = plan(df)
        assert "partial_" in text, name
    assert rows(quality.unique(skewed["items"], "order_id").filter("value = 1")) == [(HOT, ROWS // 3)]


def test_hot_window_and_hot_run(spark):
    n = F.col("id")
    payments = spark.range(ROWS).select(
        F.lit("2024-01-01").cast("timestamp").alias("window_start"),
        (n % 7).alias("order_id"),
        F.lit(0.1).alias("amount"),
    )
    got = realtime.revenue_by_minute(payments).first()
    assert (got.order_count, float(got.revenue)) == (7, ROWS / 10)
    tasks = spark.range(ROWS).select(
        F.lit("run").alias("run_id"), F.concat(F.lit("t"), (n % 3).cast("string")).alias("task_id"), F.lit("failed").alias("state")
    )
    assert rows(monitoring.failed_root_tasks(tasks)) == [("run", "t0, t1, t2")]


def test_recent_orders_shuffle_items_once(spark, large_tables):
    text = plan(registry()["product_recent_orders"](spark, SMALL))
    after_join = text[: text.index("SortMergeJoin [order_id")]
    assert "Exchange hashpartitioning(order_id" not in after_join


def test_initial_partitions_are_the_callers(spark):
    session = spark.newSession()
    assert session.conf.get(INITIAL_PARTITIONS, None) is None
    configure(session)
    assert session.conf.get(INITIAL_PARTITIONS, None) is None
    configure(session, 820_000)
    assert session.conf.get(INITIAL_PARTITIONS) == "820000"


def test_bucketed_tables_are_not_shuffled(spark, tmp_path, large_tables):
    """The pass over orders and the reconciling rule shuffle neither the items nor the order fact."""
    w = Inputs(spark, SMALL).new_warehouse()
    w.write_marts(f"{tmp_path}/marts")
    spark.sql(f"CREATE DATABASE bucket_test LOCATION '{tmp_path}/catalog'")
    try:
        plain = key_profile(w, "order_id").collect()
        w.write_bucketed(str(tmp_path), "bucket_test", 8)
        profile = bucketed_key_profile(w, w.bucketed["order_id"])
        rule = quality.revenue_matches_items(w.fact_orders, w.stg_order_items)
        assert shuffles(rule) == 0
        for frame in (profile, rule):
            text = plan(frame)
            for name in ("stg_order_items", "fact_orders"):
                scans = re.findall(rf"FileScan parquet [^\n]*bucket_test.{name}\[[^\n]*", text)
                assert scans and all("Bucketed: true" in scan for scan in scans)
            # Whatever is shuffled comes from the other tables.
            for below in re.split(r"Exchange hashpartitioning", text)[1:]:
                assert "bucket_test" not in re.split(r"SortMergeJoin|\+- Sort \[", below)[0]
        assert sorted(map(tuple, profile.collect())) == sorted(map(tuple, plain))
        assert rows(rule) == []
    finally:
        spark.sql("DROP DATABASE bucket_test CASCADE")


def rows_read(df) -> int:
    """Rows that left the scans of a query that has run: those of the row groups that were read."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_skip_row_groups(spark, tmp_path):
    """A mart is sorted by its key; row groups that cannot hold the key are skipped, by bounds or by Bloom filters."""
    people = spark.range(40_000).select(
        (F.col("id") * 7919 % 40_000).alias("customer_id"), F.lit("x").alias("country"), F.lit("2024-01-01").cast("date").alias("order_date")
    )
    names = ("dim_customers", "dim_products", "fact_payments", "mart_daily_revenue", "mart_top_products", "mart_customer_metrics")
    w = Inputs(spark, SMALL).new_warehouse()
    for name in names:
        setattr(w, name, people)
    w.dim_products = w.mart_top_products = people.withColumnRenamed("customer_id", "product_id")
    w.fact_payments = people.withColumnsRenamed({"customer_id": "payment_id"}).withColumns({"order_id": "payment_id", "created_at": "order_date"})
    # Orders are sorted by order_id, customers lie anywhere in a month; the even ones only.
    w.fact_orders = people.withColumns({"order_id": F.col("customer_id"), "customer_id": F.hash("customer_id") % 20_000 * 2})
    spark.conf.set("parquet.block.size", "4096")
    spark.conf.set("parquet.page.size", "1024")
    try:
        w.write_marts(str(tmp_path))
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.page.size")
    one = w.mart_customer_metrics.filter("customer_id = 12345")
    assert len(one.collect()) == 1 and rows_read(one) < 10_000
    order = w.fact_orders.filter("order_id = 777")
    assert len(order.collect()) == 1 and rows_read(order) < 10_000
    # An odd customer lies between the bounds of every row group, so only the Bloom filters can tell.
    nobody = w.fact_orders.filter("customer_id = 12345")
    assert nobody.collect() == [] and rows_read(nobody) < 10_000


def test_poll_history_has_no_task_with_all_polls(spark, frame):
    polls = frame(
        "poll_seq bigint, window_start timestamp, order_count bigint, revenue double",
        *[(seq, at(f"2024-01-01 00:{window:02d}:00"), 1, 1.0) for seq, window in ((1, 1), (2, 1), (4, 1), (5, 2), (900, 2), (901, 1), (5_000_000, 1))],
    )
    history = realtime.poll_history(polls)
    assert [r.poll_seq for r in history.collect()] == [901, 5, 1]
    text = plan(realtime.poll_history(polls))
    for part in text.split("Window ")[1:]:
        assert "Exchange SinglePartition" not in part.split("Exchange hashpartitioning")[0]
    assert realtime.poll_history(polls.limit(0)).collect() == []


def test_shuffles_start_with_partitions_by_the_size_of_the_input(spark, monkeypatch):
    session = spark.newSession()
    assert partitions_for(session, 1 << 20) is None and partitions_for(session, 6 << 30) == 1536
    monkeypatch.setattr(upsert, "stored_bytes", lambda *_: 1 << 30)
    Inputs(session, SMALL)
    assert int(session.conf.get(INITIAL_PARTITIONS)) == 256 * len(retail.TABLES)
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_stored_bytes_of_files_and_folders(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a").write_bytes(b"123")
    (tmp_path / "t" / "b").write_bytes(b"12")
    assert [upsert.stored_bytes(spark, str(tmp_path / p)) for p in ("t", "t/a", "none")] == [5, 3, 0]
