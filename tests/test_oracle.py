"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyhouse.plans.queries import registry
from tests.conftest import SMALL
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, SMALL) == ""


def test_every_query_has_sql():
    assert set(registry()) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["order_date", "order_count", "revenue", "units_sold", "average_order_value"]
