from __future__ import annotations

import os
import sys
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frames: ``frame("a int, b string", (1, "x"), ...)``."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def at(text: str) -> datetime:
    """A UTC moment from ``2024-01-01 00:00:00``."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def shop(frame, extra_item: bool = False) -> dict:
    """Five consistent source tables: 3 customers, 3 products, 4 orders; nothing violates a check."""
    day = at("2024-03-01 10:00:00")
    customers = frame(
        "customer_id bigint, full_name string, email string, country string, signup_date date, "
        "created_at timestamp, updated_at timestamp",
        (1, " Ann ", "ANN@x.org ", "Kenya ", date(2024, 1, 1), day, day),
        (2, "Bob", "bob@x.org", "Japan", date(2024, 1, 2), day, day),
        (3, "Cy", "cy@x.org", "Nowhere", date(2024, 1, 3), day, day),
    )
    products = frame(
        "product_id bigint, product_name string, category string, unit_price decimal(10,2), "
        "created_at timestamp, updated_at timestamp",
        (1, " Lamp", "Home", Decimal("10.00"), day, day),
        (2, "Desk", "Office ", Decimal("100.00"), day, day),
        (3, "Unsold", "Home", Decimal("5.00"), day, day),
    )
    orders = frame(
        "order_id bigint, customer_id bigint, order_status string, order_ts timestamp, created_at timestamp, "
        "updated_at timestamp",
        (1, 1, " Paid", day, day, day),
        (2, 1, "shipped", day, day, day),
        (3, 2, "Cancelled", day, day, day),
        (4, 2, "placed", at("2024-03-02 23:59:59"), day, day),
    )
    rows = [
        (1, 1, 1, 2, Decimal("10.00"), Decimal("20.00"), day),
        (2, 1, 2, 1, Decimal("100.00"), Decimal("100.00"), day),
        (3, 2, 1, 1, Decimal("10.00"), Decimal("10.00"), day),
        (4, 3, 2, 3, Decimal("100.00"), Decimal("300.00"), day),
        (5, 4, 2, 1, Decimal("100.00"), Decimal("100.00"), day),
    ]
    items = frame(
        "order_item_id bigint, order_id bigint, product_id bigint, quantity bigint, unit_price decimal(10,2), "
        "line_total decimal(10,2), created_at timestamp",
        *rows,
    )
    payments = frame(
        "payment_id bigint, order_id bigint, amount decimal(10,2), payment_method string, payment_status string, "
        "paid_at timestamp, created_at timestamp",
        (1, 1, Decimal("120.00"), "Card", "success", day, day),
        (2, 2, Decimal("10.00"), "eft", " Success", day, day),
        (3, 3, Decimal("300.00"), "wallet", "failed", None, day),
        (4, 4, Decimal("100.00"), "card", "pending", None, day),
    )
    return {
        "customers": customers,
        "products": products,
        "orders": orders,
        "order_items": items,
        "payments": payments,
    }


def seed(frame):
    return frame("country string, region string", ("Kenya", "Africa"), ("Japan", "Asia"))


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
