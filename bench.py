"""Time the headline queries on local cores and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from tallyhouse.plans.queries import registry
from tallyhouse.session import local_session

# Every kind of work once: order grain, marts, drill-down, insights, checks, change streams, sinks.
HEADLINE = (
    "int_orders_enriched",
    "int_customer_orders",
    "mart_daily_revenue",
    "mart_top_products",
    "mart_customer_metrics",
    "product_details",
    "product_sales_history",
    "product_recent_orders",
    "customers_summary",
    "api_customer_metrics",
    "category_shares",
    "weekday_averages",
    "spend_distribution",
    "mon_row_counts",
    "mon_freshness",
    "health_summary",
    "failed_root_tasks",
    "dq_unique",
    "dq_orders_have_items",
    "dq_payment_reconciliation",
    "dq_revenue_matches_items",
    "dq_report",
    "rt_revenue_by_minute",
    "rt_top_products_5min",
    "rt_history",
    "lambda_today_revenue",
    "sink_compact_upsert",
    "sink_upsert",
    "sink_mart_table",
    "st_live_revenue",
    "st_closed_revenue",
)


def seconds(spark, build, folder: str) -> float:
    started = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores)
    queries = registry()
    timings = {}
    for name in HEADLINE:
        # The median of three leaves out the first run, which compiles.
        timings[name] = round(statistics.median(seconds(spark, queries[name], folder) for _ in range(runs)), 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
