"""Models, serving and dashboard calculations on tiny tables with known answers."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import insights, marts, monitoring, realtime, serving
from tallyhouse.operators import orders as order_grain
from tallyhouse.plans.warehouse import Warehouse
from tests.conftest import at, rows, seed, shop


@pytest.fixture
def warehouse(frame):
    return Warehouse(shop(frame), lambda: seed(frame), F.lit("2024-03-03 00:00:00").cast("timestamp"))


def test_staging_cleans_text(warehouse):
    assert rows(warehouse.stg_customers, "full_name", "email", "country")[0] == ("Ann", "ann@x.org", "Kenya")
    assert [r[0] for r in rows(warehouse.stg_orders, "order_status")] == ["cancelled", "paid", "placed", "shipped"]


def test_region_falls_back_to_unknown(warehouse):
    assert rows(warehouse.dim_customers, "customer_id", "region") == [(1, "Africa"), (2, "Asia"), (3, "Unknown")]


def test_daily_revenue_counts_all_orders_but_sums_kept_ones(warehouse):
    assert rows(warehouse.mart_daily_revenue) == [
        (date(2024, 3, 1), 3, Decimal("130.00"), 4, 130.0 / 3),
        (date(2024, 3, 2), 1, Decimal("100.00"), 1, 100.0),
    ]


def test_customer_metrics_keep_customers_without_orders(warehouse):
    picked = rows(
        warehouse.mart_customer_metrics, "customer_id", "order_count", "total_order_value", "latest_order_date"
    )
    assert picked == [
        (1, 2, Decimal("130.00"), date(2024, 3, 1)),
        (2, 2, Decimal("400.00"), date(2024, 3, 2)),
        (3, 0, Decimal("0.00"), None),
    ]


def test_top_products_leave_out_cancelled_orders(warehouse):
    assert rows(warehouse.mart_top_products) == [
        (1, "Lamp", "Home", 3, Decimal("30.00")),
        (2, "Desk", "Office", 2, Decimal("200.00")),
    ]


def test_null_status_is_not_sold(frame, warehouse):
    orders = warehouse.order_measures.withColumn(
        "order_status", F.when(F.col("order_id") != 1, F.col("order_status"))
    )
    sold = serving.product_details(warehouse.dim_products, warehouse.raw["order_items"], orders)
    assert rows(sold, "product_id", "units_sold", "order_count") == [(1, 1, 1), (2, 1, 1), (3, 0, 0)]


def test_product_drill_down_of_one_product(warehouse):
    raw, orders = warehouse.raw["order_items"], warehouse.fact_orders
    details = serving.product_details(warehouse.dim_products, raw, orders, 2)
    assert rows(details, "product_id", "units_sold", "revenue", "order_count") == [(2, 2, Decimal("200.00"), 2)]
    assert serving.product_details(warehouse.dim_products, raw, orders, 99).isEmpty()
    history = serving.product_sales_history(raw, orders, 2, 1)
    assert rows(history, "order_date", "units_sold") == [(date(2024, 3, 2), 1)]
    recent = serving.product_recent_orders(raw, orders, warehouse.stg_customers, 2, 2)
    assert rows(recent, "order_id", "customer_name", "order_status") == [(3, "Bob", "cancelled"), (4, "Bob", "placed")]


def test_product_lists_agree_for_one_and_all(warehouse):
    raw, orders = warehouse.raw["order_items"], warehouse.fact_orders
    everything = serving.product_sales_history(raw, orders, limit=1).filter("product_id = 2")
    assert rows(everything) == rows(serving.product_sales_history(raw, orders, 2, 1))


def test_unknown_product_is_not_an_unsold_one(warehouse):
    assert serving.product_exists(warehouse.dim_products, 3).count() == 1
    assert serving.product_exists(warehouse.dim_products, 99).count() == 0


def test_stored_marts_equal_lazy_ones(warehouse, tmp_path):
    before = rows(warehouse.fact_orders)
    warehouse.write_marts(str(tmp_path))
    assert rows(warehouse.fact_orders) == before
    assert sorted(p.name for p in (tmp_path / "fact_orders").glob("order_month=*")) == ["order_month=2024-03"]


def test_models_are_views_for_sql(spark, warehouse):
    warehouse.register_views()
    got = spark.sql("SELECT sum(revenue) FROM mart_daily_revenue WHERE order_date >= DATE '2024-03-02'").first()[0]
    assert got == Decimal("100.00")
    assert {"int_customer_orders", "source_freshness", "stg_payments"} <= {t.name for t in spark.catalog.listTables()}


def days(frame, *values):
    return frame("revenue double, order_count bigint, units_sold bigint", *values)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([(1000.0, 10, 20), (2000.0, 15, 30)], (3000.0, 25, 50, 120.0)),
        ([(500.0, 0, 0)], (500.0, 0, 0, 0.0)),
        ([], (0.0, 0, 0, 0.0)),
    ],
)
def test_revenue_summary(frame, values, expected):
    assert rows(insights.revenue_summary(days(frame, *values))) == [expected]


def test_category_breakdown(frame):
    products = frame("category string, revenue double", ("Audio", 100.0), ("Audio", 50.0), ("Gaming", 30.0))
    assert [tuple(r) for r in insights.category_breakdown(products).collect()] == [("Audio", 150.0), ("Gaming", 30.0)]


def test_weekday_averages(frame):
    daily = frame("order_date date, revenue double", (date(2026, 9, 7), 100.0), (date(2026, 9, 14), 300.0))
    got = [(r.label, r.average) for r in insights.weekday_averages(daily).collect()]
    assert got == [("Sun", 0.0), ("Mon", 200.0), ("Tue", 0.0), ("Wed", 0.0), ("Thu", 0.0), ("Fri", 0.0), ("Sat", 0.0)]


@pytest.mark.parametrize(
    "spend, expected", [([500.0, 4000.0, 50000.0], [1, 1, 0, 0, 1]), ([1000.0], [1, 0, 0, 0, 0])]
)
def test_spend_distribution(frame, spend, expected):
    customers = frame("total_order_value double", *[(v,) for v in spend])
    assert [r.customer_count for r in insights.spend_distribution(customers).collect()] == expected


def test_spend_distribution_with_own_buckets(frame):
    customers = frame("total_order_value double", (250.0,), (750.0,))
    got = insights.spend_distribution(customers, (("low", 500), ("high", None))).collect()
    assert [(r.label, r.customer_count) for r in got] == [("low", 1), ("high", 1)]


def test_spend_above_the_last_bound_is_in_no_bucket(frame):
    customers = frame("total_order_value double", (250.0,), (750.0,))
    assert [r.customer_count for r in insights.spend_distribution(customers, (("low", 500),)).collect()] == [1]


@pytest.mark.parametrize("counts, expected", [([75, 25], [25.0, 75.0]), ([0], [0.0]), ([], [])])
def test_region_shares(frame, counts, expected):
    regions = frame("region string, customer_count bigint", *[(f"r{i}", n) for i, n in enumerate(counts)])
    assert sorted(r.percent for r in insights.region_shares(regions).collect()) == expected


@pytest.mark.parametrize(
    "previous, current, expected", [(100.0, 120.0, 20.0), (100.0, 80.0, -20.0), (0.0, 100.0, 0.0), (None, 100.0, 0.0)]
)
def test_percent_change(frame, previous, current, expected):
    values = [(date(2024, 1, 2), current, 5)]
    if previous is not None:
        values.append((date(2024, 1, 1), previous, 5))
    daily = frame("order_date date, revenue double, order_count bigint", *values)
    got = insights.latest_change(daily).first()
    assert (got.order_date, round(got.revenue_change, 9)) == (date(2024, 1, 2), expected)


def test_percent_change_of_nothing(frame):
    daily = frame("order_date date, revenue double, order_count bigint")
    assert insights.latest_change(daily).isEmpty()


def test_customers_summary(frame):
    schema = "order_count bigint, total_order_value double, total_units_sold bigint"
    got = serving.customers_summary(frame(schema, *[(5, 1000.0, 20)] * 10)).first()
    assert (got.customer_count, got.total_orders, got.total_revenue, got.total_units) == (10, 50, 10000.0, 200)
    assert (got.average_customer_spend, got.average_orders_per_customer) == (1000.0, 5.0)
    nobody = serving.customers_summary(frame(schema)).first()
    assert (nobody.customer_count, nobody.average_customer_spend, nobody.average_orders_per_customer) == (0, 0.0, 0.0)


def test_long_names_are_cut(frame):
    schema = "product_id bigint, product_name string, revenue double"
    got = insights.top_product_chart(frame(schema, (1, "x" * 17, 5.0), (2, "y" * 16, 9.0))).collect()
    assert [r.name for r in got] == ["y" * 16, "x" * 16 + "…"]


def test_bar_width_of_a_list_without_revenue(frame):
    schema = "product_id bigint, product_name string, category string, revenue double"
    got = insights.product_bar_width(frame(schema, (1, "a", "c", 0.0))).first()
    assert (got.position, got.width) == (1, 0.0)


CHECK = "name string, status string"


@pytest.mark.parametrize(
    "statuses, expected",
    [
        (["healthy"] * 2 + ["degraded"] * 3 + ["unhealthy"], ("unhealthy", 6, 2, 3, 1)),
        (["healthy", "degraded"], ("degraded", 2, 1, 1, 0)),
        ([], ("healthy", 0, 0, 0, 0)),
    ],
)
def test_health_summary(frame, statuses, expected):
    checks = frame(CHECK, *[(f"c{i}", s) for i, s in enumerate(statuses)])
    assert rows(monitoring.health_summary(checks)) == [expected]


@pytest.mark.parametrize(
    "checks, layer, expected",
    [
        ([("Batch run", "healthy"), ("Batch mart", "degraded")], "batch", "degraded"),
        ([("Speed stream", "healthy"), ("Speed list", "unhealthy")], "speed", "unhealthy"),
        ([("Something", "unhealthy")], "serving", "healthy"),
        ([], "batch", "healthy"),
    ],
)
def test_layer_status(frame, checks, layer, expected):
    got = {r.layer: r.status for r in monitoring.layer_status(frame(CHECK, *checks), {"batch": ("Batch",), "speed": ("Speed",), "serving": ("Serving",)}).collect()}
    assert got[layer] == expected and len(got) == 3


def noon():
    return F.lit("2024-03-01 12:00:00").cast("timestamp")


@pytest.mark.parametrize(
    "stamp, expected", [("2024-03-01 11:55:00", "healthy"), ("2024-03-01 11:54:59", "degraded"), (None, "degraded")]
)
def test_staleness(frame, stamp, expected):
    moment = [(at(stamp),)] if stamp else []
    windows = frame("window_start timestamp", *moment)
    assert monitoring.stream_staleness(windows, noon()).first().status == expected
    orders = frame("created_at timestamp", *moment)
    assert monitoring.order_activity_check(orders, noon()).first().status == expected


def test_mart_populated(frame):
    schema = "total_order_value double"
    assert monitoring.mart_populated_check(frame(schema)).first().status == "degraded"
    got = monitoring.mart_populated_check(frame(schema, (5.0,))).first()
    assert (got.status, got.details["customer_count"]) == ("healthy", "1")


def test_failed_tasks(frame):
    tasks = frame(
        "run_id string, task_id string, state string",
        ("a", "load", "failed"),
        ("a", "build", "failed"),
        ("a", "check", "upstream_failed"),
        ("b", "load", "success"),
    )
    assert rows(monitoring.failed_root_tasks(tasks)) == [("a", "build, load"), ("b", None)]


def test_freshness_has_an_interval(warehouse):
    got = {r.table_name: r for r in warehouse.source_freshness.collect()}
    assert got["products"].table_type == "reference"
    assert got["orders"].source_age.total_seconds() == got["orders"].source_age_seconds == 38 * 3600


@pytest.mark.parametrize(
    "batch, speed, expected",
    [
        ((100, 5000.0), (3, 150.0), (103, 5150.0)),
        ((250, 12345.67), (0, 0.0), (250, 12345.67)),
        ((0, 0.0), (5, 299.99), (5, 299.99)),
        (None, None, (0, 0.0)),
    ],
)
def test_merge_layers(frame, batch, speed, expected):
    daily = frame("order_date date, order_count bigint, revenue double", *([(date(2024, 3, 1), *batch)] if batch else []))
    windows = frame(
        "window_start timestamp, order_count bigint, revenue double", *([(at("2024-03-01 11:59:00"), *speed)] if speed else [])
    )
    got = realtime.lambda_today_revenue(daily, windows, F.lit("2024-03-01").cast("date")).first()
    assert (got.merged_orders, got.merged_revenue) == expected
    assert got.order_date == date(2024, 3, 1)


def test_merge_can_leave_out_windows_the_batch_has(frame):
    daily = frame("order_date date, order_count bigint, revenue double", (date(2024, 3, 1), 10, 100.0))
    windows = frame("window_start timestamp, order_count bigint, revenue double", (at("2024-03-01 11:59:00"), 2, 20.0))
    cutoff = F.lit("2024-03-01 11:59:00").cast("timestamp")
    got = realtime.lambda_today_revenue(daily, windows, F.lit("2024-03-01").cast("date"), cutoff).first()
    assert (got.merged_orders, got.merged_revenue, got.window_start) == (10, 100.0, None)


def test_poll_history_keeps_returning_windows(frame):
    first, second = at("2024-03-01 11:58:00"), at("2024-03-01 11:59:00")
    polls = frame(
        "poll_seq bigint, window_start timestamp, order_count bigint, revenue double",
        *[(i, w, 1, 1.0) for i, w in enumerate([first, first, second, second, first])],
    )
    assert [r.poll_seq for r in realtime.poll_history(polls).collect()] == [4, 2, 0]
    assert [r.poll_seq for r in realtime.poll_history(polls, 2).collect()] == [4, 2]


def test_live_list_names_every_product(frame):
    schema = "window_start timestamp, product_id bigint, product_name string, units_sold bigint, revenue decimal(22,2)"
    old, new = at("2024-03-01 11:50:00"), at("2024-03-01 11:55:00")
    sales = frame(
        schema,
        (old, 1, "Lamp", 1, Decimal("99.00")),
        (new, 7, None, 1, Decimal("5.00")),
        (new, 2, "Desk", 1, Decimal("7.00")),
    )
    top = realtime.live_top_products(sales)
    got = [tuple(r) for r in realtime.served_top_products(top).collect()]
    assert got == [("Desk", Decimal("7.00")), ("product-7", Decimal("5.00"))]


def test_repeated_order_rows_are_counted_once(frame):
    orders = frame(
        "order_id bigint, customer_id bigint, order_date date, order_status string, order_value decimal(12,2), units_sold bigint",
        (1, 7, date(2024, 1, 1), "paid", Decimal("2.00"), 1),
        (1, 7, date(2024, 1, 1), "paid", Decimal("2.00"), 1),
        (2, 7, date(2024, 1, 1), "paid", Decimal("3.00"), 1),
    )
    assert rows(marts.mart_daily_revenue(orders), "order_count") == [(2,)]
    assert rows(order_grain.orders_per_customer(orders), "customer_id", "order_count") == [(7, 2)]
