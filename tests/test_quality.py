"""Every check on a clean frame and on one that violates it."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality as q
from tallyhouse.plans.check_suite import check_report
from tallyhouse.plans.warehouse import Warehouse
from tests.conftest import at, rows, seed, shop

FEW = {"customers": 3, "products": 3, "orders": 4, "order_items": 5, "payments": 4}


def now():
    return F.lit("2024-03-03 00:00:00").cast("timestamp")


@pytest.fixture
def warehouse(frame):
    return Warehouse(shop(frame), lambda: seed(frame), now())


def test_declared_checks_are_complete():
    assert sum(len(c) for c in q.NOT_NULL.values()) == 44
    assert (len(q.UNIQUE), len(q.RELATIONSHIPS), len(q.ACCEPTED_VALUES), len(q.RULES)) == (14, 6, 4, 16)


def test_clean_tables_pass_everything(warehouse, frame):
    # The order that was cancelled has items worth 300 and a failed payment; paid and shipped ones agree.
    report = check_report(warehouse, now(), FEW)
    assert report.count() == 68 + 16
    assert rows(report.filter("failures > 0")) == []
    for name, rule in q.RULES.items():
        assert rule(warehouse, now(), FEW).isEmpty(), name


def test_not_null(frame):
    df = frame("a int, b string", (1, "x"), (2, None))
    assert rows(q.not_null(df, "a")) == [] and rows(q.not_null(df, "b")) == [(2, None)]


def test_unique_ignores_null(frame):
    df = frame("a int", (1,), (1,), (2,), (None,), (None,))
    assert rows(q.unique(df, "a")) == [(1, 2)]


def test_relationships_ignore_null(frame):
    child, parent = frame("k int", (1,), (7,), (7,), (None,)), frame("id int", (1,), (1,), (2,))
    assert rows(q.relationships(child, "k", parent, "id")) == [(7, 2)]


def test_accepted_values_ignore_null(frame):
    df = frame("s string", ("a",), ("z",), (None,))
    assert rows(q.accepted_values(df, "s", ("a", "b"))) == [("z", 1)]


def items(frame, quantity=1, unit_price="1.00", line_total="1.00"):
    schema = "order_item_id bigint, order_id bigint, quantity bigint, unit_price decimal(12,2), line_total decimal(12,2)"
    return frame(schema, (1, 1, quantity, Decimal(unit_price), Decimal(line_total)))


def facts(frame, *values):
    schema = "order_id bigint, order_status string, order_value decimal(22,2), successful_payment_amount decimal(22,2)"
    return frame(schema, *[(i, s, v and Decimal(v), p and Decimal(p)) for i, s, v, p in values])


def payments(frame, status, paid, amount="1.00"):
    schema = "payment_id bigint, order_id bigint, amount decimal(12,2), payment_status string, paid_at timestamp"
    return frame(schema, (1, 1, Decimal(amount), status, at("2024-03-01 00:00:00") if paid else None))


VIOLATIONS = {
    "no_future_orders": lambda f: {
        "stg_orders": f(
            "order_id bigint, order_ts timestamp, order_date date",
            (1, at("2024-03-03 00:00:01"), date(2024, 3, 3)),
            (2, at("2024-03-03 00:00:00"), date(2024, 3, 3)),
        )
    },
    "nonneg_customer_order_counts": lambda f: {
        "mart_customer_metrics": f("customer_id bigint, order_count bigint", (1, -1), (2, 0))
    },
    "nonneg_line_totals": lambda f: {"stg_order_items": items(f, line_total="-0.01")},
    "nonneg_order_counts": lambda f: {
        "mart_daily_revenue": f("order_date date, order_count bigint", (date(2024, 1, 1), -1), (date(2024, 1, 2), 0))
    },
    "nonneg_item_prices": lambda f: {"stg_order_items": items(f, unit_price="-0.01")},
    "nonneg_payments": lambda f: {"stg_payments": payments(f, "success", True, "-0.01")},
    "nonneg_product_prices": lambda f: {
        "stg_products": f("product_id bigint, unit_price decimal(12,2)", (1, Decimal("-1.00")), (2, Decimal("0.00")))
    },
    "nonneg_revenue": lambda f: {
        "mart_daily_revenue": f("order_date date, revenue double", (date(2024, 1, 1), -0.5), (date(2024, 1, 2), 0.0))
    },
    "nonneg_units_sold": lambda f: {"mart_top_products": f("product_id bigint, units_sold bigint", (1, -1), (2, 0))},
    "orders_have_items": lambda f: {
        "fact_orders": facts(f, (1, "paid", "1", "1"), (2, "paid", "1", "1")),
        "stg_order_items": items(f),
    },
    "payment_reconciliation": lambda f: {
        "fact_orders": facts(
            f, (1, "paid", "1.00", "1.02"), (2, "shipped", "1.00", "1.01"), (3, "placed", "1.00", "9.00"), (4, None, "1.00", "9.00")
        )
    },
    "positive_quantities": lambda f: {"stg_order_items": items(f, quantity=0)},
    "revenue_matches_items": lambda f: {
        "fact_orders": facts(f, (1, "paid", "1.01", "0"), (2, "paid", "0.02", "0")),
        "stg_order_items": items(f),
    },
    "min_row_counts": lambda f: {
        "source_row_counts": f("table_name string, row_count bigint", ("customers", 2), ("products", 3), ("other", 0))
    },
    "success_has_paid_at": lambda f: {"stg_payments": payments(f, "success", False)},
    "unpaid_has_no_paid_at": lambda f: {"stg_payments": payments(f, "pending", True)},
}


@pytest.mark.parametrize("name", sorted(q.RULES))
def test_rule_finds_exactly_its_violation(frame, name):
    assert q.RULES[name](VIOLATIONS[name](frame), now(), FEW).count() == 1


def test_report_counts_violations(frame, warehouse):
    warehouse.stg_order_items = warehouse.stg_order_items.unionByName(warehouse.stg_order_items)
    failed = dict(rows(check_report(warehouse, now(), FEW).filter("failures > 0")))
    assert failed == {"unique:stg_order_items.order_item_id": 5, "rule:payment_reconciliation": 2}
