"""The SQL every query must agree with, written against the retail tables.

``SHARED`` defines the source tables, models and change streams as CTEs; each query is one final
SELECT over them. Money is summed as DECIMAL and leaves as DOUBLE.
"""

from __future__ import annotations

SHARED = """
WITH raw_customers AS (
    SELECT c_custkey AS customer_id, ' ' || c_name || '  ' AS full_name,
           ' ' || c_name || '@Example.com' AS email, n_name || ' ' AS country,
           CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), seed AS (
    SELECT n_name AS country, r_name AS region
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'
), raw_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CASE WHEN o_orderstatus = 'F' THEN ' Shipped'
                WHEN o_orderstatus = 'O' THEN 'placed'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0 THEN 'CANCELLED '
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'canceled'
                ELSE 'Paid' END AS order_status,
           CAST(o_orderdate AS TIMESTAMP) AS order_ts, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
    FROM orders
), stg_customers AS (
    SELECT customer_id, trim(full_name) AS full_name, lower(trim(email)) AS email, trim(country) AS country,
           signup_date, CAST(signup_date AS TIMESTAMP) AS created_at, CAST(signup_date AS TIMESTAMP) AS updated_at
    FROM raw_customers
), stg_products AS (
    SELECT p_partkey AS product_id, trim(' ' || p_name) AS product_name, trim(p_type || ' ') AS category,
           CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
           TIMESTAMP '1995-01-01 00:00:00' AS created_at, TIMESTAMP '1995-01-01 00:00:00' AS updated_at
    FROM part
), stg_orders AS (
    SELECT order_id, customer_id, lower(trim(order_status)) AS order_status, order_ts,
           order_ts AS created_at, order_ts AS updated_at, CAST(order_ts AS DATE) AS order_date
    FROM raw_orders
), stg_order_items AS (
    SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_quantity AS BIGINT) AS quantity,
           CAST(floor(CAST(round(l_extendedprice * 100) AS BIGINT) / l_quantity) / 100 AS DECIMAL(12,2)) AS unit_price,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total, CAST(l_shipdate AS TIMESTAMP) AS created_at
    FROM lineitem
), stg_payments AS (
    SELECT order_id AS payment_id, order_id, amount,
           CASE customer_id % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'eft' ELSE 'wallet' END AS payment_method,
           CASE WHEN lower(trim(order_status)) IN ('paid', 'shipped') THEN 'success'
                WHEN lower(trim(order_status)) = 'placed' THEN 'pending' ELSE 'failed' END AS payment_status,
           CASE WHEN lower(trim(order_status)) IN ('paid', 'shipped') THEN order_ts END AS paid_at,
           order_ts AS created_at
    FROM raw_orders
), item_totals AS (
    SELECT order_id, CAST(sum(quantity) AS BIGINT) AS units_sold, sum(line_total) AS order_value
    FROM stg_order_items GROUP BY order_id
), payment_totals AS (
    SELECT order_id, sum(CASE WHEN payment_status = 'success' THEN amount ELSE 0 END) AS successful_payment_amount
    FROM stg_payments GROUP BY order_id
), fact_orders AS (
    SELECT o.order_id, o.customer_id, c.full_name AS customer_name, c.email AS customer_email, c.country,
           o.order_status, o.order_ts, o.order_date, coalesce(i.units_sold, 0) AS units_sold,
           coalesce(i.order_value, 0) AS order_value,
           coalesce(p.successful_payment_amount, 0) AS successful_payment_amount
    FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
    LEFT JOIN item_totals i ON o.order_id = i.order_id LEFT JOIN payment_totals p ON o.order_id = p.order_id
), customer_orders AS (
    SELECT customer_id, customer_name, customer_email, country, count(DISTINCT order_id) AS order_count,
           coalesce(sum(order_value), 0) AS total_order_value,
           CAST(coalesce(sum(units_sold), 0) AS BIGINT) AS total_units_sold,
           min(order_date) AS first_order_date, max(order_date) AS latest_order_date
    FROM fact_orders GROUP BY customer_id, customer_name, customer_email, country
), dim_customers AS (
    SELECT c.customer_id, c.full_name, c.email, c.country, coalesce(s.region, 'Unknown') AS region,
           c.signup_date, c.created_at, c.updated_at
    FROM stg_customers c LEFT JOIN seed s ON c.country = s.country
), daily AS (
    SELECT order_date, count(DISTINCT order_id) AS order_count,
           sum(CASE WHEN order_status NOT IN ('cancelled', 'canceled') THEN order_value ELSE 0 END) AS revenue,
           CAST(sum(CASE WHEN order_status NOT IN ('cancelled', 'canceled') THEN units_sold ELSE 0 END) AS BIGINT)
               AS units_sold
    FROM fact_orders GROUP BY order_date
), sold AS (
    SELECT i.order_id, i.product_id, i.quantity, i.line_total, o.order_date
    FROM stg_order_items i JOIN fact_orders o ON i.order_id = o.order_id
    WHERE o.order_status NOT IN ('cancelled', 'canceled')
), top_products AS (
    SELECT s.product_id, p.product_name, p.category, CAST(sum(s.quantity) AS BIGINT) AS units_sold,
           sum(s.line_total) AS revenue
    FROM sold s JOIN stg_products p ON s.product_id = p.product_id GROUP BY ALL
), customer_metrics AS (
    SELECT c.customer_id, c.full_name, c.email, c.country, c.region, coalesce(o.order_count, 0) AS order_count,
           coalesce(o.total_order_value, 0) AS total_order_value,
           coalesce(o.total_units_sold, 0) AS total_units_sold, o.first_order_date, o.latest_order_date
    FROM dim_customers c LEFT JOIN customer_orders o ON c.customer_id = o.customer_id
), row_counts AS (
    SELECT 'customers' AS table_name, count(*) AS row_count FROM stg_customers
    UNION ALL SELECT 'products', count(*) FROM stg_products
    UNION ALL SELECT 'orders', count(*) FROM stg_orders
    UNION ALL SELECT 'order_items', count(*) FROM stg_order_items
    UNION ALL SELECT 'payments', count(*) FROM stg_payments
), ev AS (
    SELECT event_id, user_id, event_type, value, CAST(ts AS TIMESTAMP) AS ts,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
), pay AS (
    SELECT event_id AS payment_id, user_id AS order_id, value AS amount,
           CASE WHEN event_id % 50 <> 0 THEN ts ELSE TIMESTAMP '2024-01-31 00:00:00' END AS event_time
    FROM ev WHERE event_type IN ('purchase', 'click')
), revenue_windows AS (
    SELECT date_trunc('minute', event_time) AS window_start, count(DISTINCT order_id) AS order_count,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM pay GROUP BY 1
), item_ev AS (
    SELECT user_id % 150 - 3 AS product_id, k AS quantity, value AS unit_price,
           CASE WHEN event_id % 7 <> 0 THEN value END AS line_total, ts AS event_time,
           time_bucket(INTERVAL '5 minutes', ts) AS window_start
    FROM ev WHERE event_type IN ('purchase', 'click')
), product_windows AS (
    SELECT i.window_start, i.product_id, p.product_name, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
           CAST(sum(coalesce(CAST(i.line_total AS DECIMAL(18,2)), i.quantity * CAST(i.unit_price AS DECIMAL(18,2)), 0))
               AS DOUBLE) AS revenue
    FROM item_ev i LEFT JOIN stg_products p ON i.product_id = p.product_id GROUP BY ALL
), staging_log AS (
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(DISTINCT user_id) AS order_count,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS revenue, max(ts) AS ingested_at
    FROM ev GROUP BY 1, 2
), latest_staged AS (
    SELECT window_start, event_type, order_count, revenue, ingested_at FROM (
        SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY ingested_at DESC) AS rn FROM staging_log)
    WHERE rn = 1
)
"""

DAILY_COLUMNS = """order_date, order_count, CAST(revenue AS DOUBLE) AS revenue, units_sold"""
FACT = """SELECT order_id, customer_id, customer_name, customer_email, country, order_status, order_ts, order_date,
       units_sold, CAST(order_value AS DOUBLE) AS order_value,
       CAST(successful_payment_amount AS DOUBLE) AS successful_payment_amount FROM fact_orders"""
METRICS = """SELECT customer_id, full_name, email, country, region, order_count,
       CAST(total_order_value AS DOUBLE) AS total_order_value, total_units_sold, first_order_date,
       latest_order_date FROM customer_metrics"""
TOP = """SELECT product_id, product_name, category, units_sold, CAST(revenue AS DOUBLE) AS revenue FROM top_products"""
DAILY_AOV = "CAST(revenue AS DOUBLE) / order_count"
LAST_DAYS = "(SELECT * FROM daily ORDER BY order_date DESC LIMIT {n})"
SUMMARY = """SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(order_count) AS BIGINT) AS total_orders,
       CAST(sum(units_sold) AS BIGINT) AS total_units,
       CAST(sum(revenue) AS DOUBLE) / CAST(sum(order_count) AS DOUBLE) AS avg_order_value FROM {days}"""
HEALTH_STATUS = """
SELECT 'Speed revenue windows' AS name,
       CASE WHEN max(window_start) IS NULL OR date_diff('second', max(window_start), TIMESTAMP '2024-01-31') > 300
            THEN 'degraded' ELSE 'healthy' END AS status FROM revenue_windows
UNION ALL SELECT 'Batch customer mart', CASE WHEN count(*) = 0 THEN 'degraded' ELSE 'healthy' END FROM customer_metrics
UNION ALL SELECT 'Serving product list',
       CASE WHEN max(window_start) IS NULL OR date_diff('second', max(window_start), TIMESTAMP '2024-01-31') > 300
            THEN 'degraded' ELSE 'healthy' END FROM product_windows
UNION ALL SELECT 'Batch order intake',
       CASE WHEN max(created_at) IS NULL OR date_diff('second', max(created_at), TIMESTAMP '2024-01-31') > 300
            THEN 'degraded' ELSE 'healthy' END FROM stg_orders"""

FRESHNESS = """(SELECT table_name, table_type, latest_source_timestamp, TIMESTAMP '2001-08-01 00:00:00' AS checked_at,
        TIMESTAMP '2001-08-01 00:00:00' - latest_source_timestamp AS source_age,
        date_diff('second', latest_source_timestamp, TIMESTAMP '2001-08-01 00:00:00') AS source_age_seconds FROM (
        SELECT 'customers' AS table_name, 'transactional' AS table_type, max(updated_at) AS latest_source_timestamp
        FROM stg_customers
        UNION ALL SELECT 'products', 'reference', max(updated_at) FROM stg_products
        UNION ALL SELECT 'orders', 'transactional', max(updated_at) FROM stg_orders
        UNION ALL SELECT 'order_items', 'transactional', max(created_at) FROM stg_order_items
        UNION ALL SELECT 'payments', 'transactional', max(created_at) FROM stg_payments))"""
COUNTED = "(SELECT *, TIMESTAMP '2001-08-01 00:00:00' AS checked_at FROM row_counts)"


def _run_outcomes(kind: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
               FROM ev WHERE event_type = '{kind}') WHERE rn = 1"""


def _spend(bounds: list[tuple[str, float | None]]) -> str:
    rows, low = [], None
    for position, (label, high) in enumerate(bounds):
        above = "" if low is None else f" AND total_order_value > {low}"
        below = "" if high is None else f" AND total_order_value <= {high}"
        rows.append(
            f"SELECT {position} AS position, '{label}' AS label, count(*) AS customer_count "
            f"FROM customer_metrics WHERE true{above}{below}"
        )
        low = high
    return " UNION ALL ".join(rows)


# Declared checks, listed here again so that the report is checked against an independent list.
NULL_CHECKS = """
stg_customers: customer_id email country
stg_products: product_id product_name unit_price
stg_orders: order_id customer_id order_date order_status
stg_order_items: order_item_id order_id product_id quantity
stg_payments: payment_id order_id amount payment_status payment_method
dim_customers: customer_id email region
dim_products: product_id product_name
fact_orders: order_id customer_id
fact_payments: payment_id order_id
mart_daily_revenue: order_date order_count revenue
mart_top_products: product_id units_sold revenue
mart_customer_metrics: customer_id order_count
"""
CTE_OF = {
    "dim_products": "stg_products",
    "fact_payments": "stg_payments",
    "mart_daily_revenue": "daily",
    "mart_top_products": "top_products",
    "mart_customer_metrics": "customer_metrics",
}
RULE_COUNTS = {
    "no_future_orders": "stg_orders WHERE order_ts > TIMESTAMP '2001-06-30'",
    "nonneg_customer_order_counts": "customer_metrics WHERE order_count < 0",
    "nonneg_line_totals": "stg_order_items WHERE line_total < 0",
    "nonneg_order_counts": "daily WHERE order_count < 0",
    "nonneg_item_prices": "stg_order_items WHERE unit_price < 0",
    "nonneg_payments": "stg_payments WHERE amount < 0",
    "nonneg_product_prices": "stg_products WHERE unit_price < 0",
    "nonneg_revenue": "daily WHERE revenue < 0",
    "nonneg_units_sold": "top_products WHERE units_sold < 0",
    "orders_have_items": "fact_orders WHERE order_id NOT IN (SELECT order_id FROM stg_order_items)",
    "payment_reconciliation": "fact_orders WHERE order_status IN ('paid', 'shipped') "
    "AND abs(order_value - successful_payment_amount) > 0.01",
    "positive_quantities": "stg_order_items WHERE quantity <= 0",
    "revenue_matches_items": "(SELECT o.order_id, o.order_value, coalesce(sum(i.line_total), 0) AS again "
    "FROM fact_orders o LEFT JOIN stg_order_items i ON o.order_id = i.order_id GROUP BY ALL) "
    "WHERE abs(order_value - again) > 0.01",
    "min_row_counts": "row_counts WHERE (table_name = 'customers' AND row_count < 5000) "
    "OR (table_name = 'products' AND row_count < 5) OR (table_name = 'orders' AND row_count < 50000) "
    "OR (table_name = 'order_items' AND row_count < 100000) OR (table_name = 'payments' AND row_count < 50000)",
    "success_has_paid_at": "stg_payments WHERE payment_status = 'success' AND paid_at IS NULL",
    "unpaid_has_no_paid_at": "stg_payments WHERE payment_status IN ('failed', 'pending') AND paid_at IS NOT NULL",
}


# Where the tables keep a rule, some rows of the table it looks at are spoiled: rule to (table, column, new value).
SPOILED = {
    "nonneg_customer_order_counts": ("customer_metrics", "order_count", "CASE WHEN customer_id % 97 = 0 THEN -1 ELSE order_count END"),
    "nonneg_line_totals": ("stg_order_items", "line_total", "CASE WHEN order_item_id % 97 = 0 THEN -line_total ELSE line_total END"),
    "nonneg_order_counts": ("daily", "order_count", "CASE WHEN day(order_date) = 13 THEN -order_count ELSE order_count END"),
    "nonneg_item_prices": ("stg_order_items", "unit_price", "CASE WHEN order_item_id % 97 = 0 THEN -unit_price ELSE unit_price END"),
    "nonneg_payments": ("stg_payments", "amount", "CASE WHEN payment_id % 97 = 0 THEN -amount ELSE amount END"),
    "nonneg_product_prices": ("stg_products", "unit_price", "CASE WHEN product_id % 97 = 0 THEN -unit_price ELSE unit_price END"),
    "nonneg_revenue": ("daily", "revenue", "CASE WHEN day(order_date) = 13 THEN -1 - revenue ELSE revenue END"),
    "nonneg_units_sold": ("top_products", "units_sold", "CASE WHEN product_id % 97 = 0 THEN -units_sold ELSE units_sold END"),
    "positive_quantities": ("stg_order_items", "quantity", "CASE WHEN order_item_id % 97 = 0 THEN 0 ELSE quantity END"),
    "revenue_matches_items": ("fact_orders", "order_value", "CASE WHEN order_id % 97 = 0 THEN order_value + 1 ELSE order_value END"),
    "success_has_paid_at": ("stg_payments", "paid_at", "CASE WHEN payment_id % 97 <> 0 THEN paid_at END"),
    "unpaid_has_no_paid_at": ("stg_payments", "paid_at", "CASE WHEN payment_id % 97 = 0 THEN created_at ELSE paid_at END"),
}


def _violations(rule: str) -> str:
    """What a rule looks at and its condition, over the spoiled table where there is one."""
    source = RULE_COUNTS[rule]
    if rule not in SPOILED:
        return source
    table, column, value = SPOILED[rule]
    spoiled = f"(SELECT * REPLACE ({value} AS {column}) FROM {table}) AS {table}_spoiled"
    if rule == "revenue_matches_items":
        return source.replace("fact_orders o", spoiled.replace("AS fact_orders_spoiled", "o"))
    return source.replace(table, spoiled, 1)


def _report() -> str:
    def counted(name: str, source: str) -> str:
        return f"SELECT '{name}' AS check_name, count(*) AS failures FROM {source}"

    parts = []
    for line in NULL_CHECKS.strip().splitlines():
        table, columns = line.split(": ")
        cte = CTE_OF.get(table, table)
        parts += [counted(f"not_null:{table}.{c}", f"{cte} WHERE {c} IS NULL") for c in columns.split()]
        key = columns.split()[0]
        parts.append(
            counted(f"unique:{table}.{key}", f"(SELECT {key} FROM {cte} GROUP BY {key} HAVING count(*) > 1)")
        )
    monitored = {
        "source_row_counts": ("table_name", "row_count", "checked_at"),
        "source_freshness": ("table_name", "table_type", "latest_source_timestamp", "checked_at", "source_age"),
    }
    for table, columns in monitored.items():
        source = COUNTED if table == "source_row_counts" else FRESHNESS
        parts += [counted(f"not_null:{table}.{c}", f"{source} WHERE {c} IS NULL") for c in columns]
        repeated = f"(SELECT table_name FROM {source} GROUP BY table_name HAVING count(*) > 1)"
        parts.append(counted(f"unique:{table}.table_name", repeated))
    for child, key, parent in (
        ("stg_orders", "customer_id", "stg_customers"),
        ("stg_order_items", "order_id", "stg_orders"),
        ("stg_order_items", "product_id", "stg_products"),
        ("stg_payments", "order_id", "stg_orders"),
        ("fact_orders", "customer_id", "dim_customers"),
        ("fact_payments", "order_id", "fact_orders"),
    ):
        source = f"{CTE_OF.get(child, child)} WHERE {key} NOT IN (SELECT {key} FROM {parent})"
        parts.append(counted(f"relationships:{child}.{key}", source))
    for table, column, values in (
        ("stg_orders", "order_status", "'cancelled', 'paid', 'placed', 'shipped'"),
        ("stg_payments", "payment_status", "'failed', 'pending', 'success'"),
        ("stg_payments", "payment_method", "'card', 'eft', 'wallet'"),
    ):
        parts.append(
            counted(f"accepted_values:{table}.{column}", f"{table} WHERE {column} NOT IN ({values})")
        )
    kinds = f"{FRESHNESS} WHERE table_type NOT IN ('transactional', 'reference')"
    parts.append(counted("accepted_values:source_freshness.table_type", kinds))
    parts += [counted(f"rule:{name}", source) for name, source in RULE_COUNTS.items()]
    return " UNION ALL ".join(parts)


# A file a trigger: slices of the events in the order of their ids, every 37th event two files later. A trigger lets in
# what the watermark of the trigger before has not closed, that is the newest time up to two triggers back.
LATE = """WITH filed AS (
        SELECT event_id AS payment_id, user_id AS order_id, value AS amount, ts AS event_time,
               date_trunc('minute', ts) AS window_start,
               CASE WHEN event_id % 37 = 0 AND slice + 2 < 6 THEN slice + 2 ELSE slice END AS file
        FROM (SELECT *, event_id * 6 // (SELECT max(event_id) + 1 FROM ev) AS slice FROM ev)
        WHERE event_type IN ('purchase', 'click')
    ), newest AS (SELECT file, max(event_time) AS newest FROM filed GROUP BY file)
    SELECT filed.*, window_start + INTERVAL '1 minute' <= (
        SELECT max(newest) - INTERVAL '2 minutes' FROM newest WHERE newest.file <= filed.file - 2) IS TRUE AS late
    FROM filed"""

FINAL = {
    "src_full_snapshot": "SELECT table_name, row_count FROM row_counts",
    "src_seed_csv": "SELECT country, region FROM seed",
    "src_drop_generated": """SELECT order_item_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(quantity * unit_price AS DOUBLE) AS line_total FROM stg_order_items""",
    "src_cdc_payments": """SELECT CASE WHEN event_type IN ('purchase', 'error') THEN 'c' WHEN event_type = 'click' THEN 'u'
        WHEN event_type = 'signup' THEN 'r' ELSE 'd' END AS op, event_id AS payment_id, user_id AS order_id,
        value AS amount, 'card' AS payment_method,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS payment_status,
        CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS paid_at,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at FROM ev""",
    "src_cdc_items": """SELECT CASE WHEN event_type IN ('purchase', 'click') THEN 'c' ELSE 'u' END AS op,
        event_id AS order_item_id, event_id AS order_id, user_id % 150 - 3 AS product_id, k AS quantity,
        value AS unit_price, CASE WHEN event_id % 7 <> 0 THEN value END AS line_total,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at FROM ev""",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_products": "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM stg_products",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(line_total AS DOUBLE) AS line_total) FROM stg_order_items""",
    "stg_payments": "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM stg_payments",
    "agg_items_per_order": "SELECT order_id, units_sold, CAST(order_value AS DOUBLE) AS order_value FROM item_totals",
    "agg_success_payment_per_order": """SELECT order_id,
        CAST(successful_payment_amount AS DOUBLE) AS successful_payment_amount FROM payment_totals""",
    "int_orders_enriched": FACT,
    "fact_orders": FACT,
    "int_customer_orders": "SELECT * REPLACE (CAST(total_order_value AS DOUBLE) AS total_order_value) FROM customer_orders",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_products": "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM stg_products",
    "fact_payments": "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM stg_payments",
    "mart_daily_revenue": f"SELECT {DAILY_COLUMNS}, {DAILY_AOV} AS average_order_value FROM daily",
    "sink_mart_table": f"SELECT {DAILY_COLUMNS}, {DAILY_AOV} AS average_order_value FROM daily",
    "mart_top_products": TOP,
    "mart_customer_metrics": METRICS,
    "mart_customer_metrics_recent": """SELECT c.customer_id, c.full_name, c.email, c.country, c.region,
        count(DISTINCT o.order_id) AS order_count, CAST(coalesce(sum(o.order_value), 0) AS DOUBLE) AS total_order_value,
        CAST(coalesce(sum(o.units_sold), 0) AS BIGINT) AS total_units_sold, min(o.order_date) AS first_order_date,
        max(o.order_date) AS latest_order_date
        FROM dim_customers c LEFT JOIN fact_orders o ON c.customer_id = o.customer_id AND o.order_date >= DATE '2001-01-01'
        GROUP BY ALL""",
    "flt_success_payments": "SELECT payment_id, order_id, amount, event_time FROM pay",
    "flt_items_created": "SELECT product_id, quantity, unit_price, line_total, event_time FROM item_ev",
    "flt_not_cancelled": """SELECT order_id, order_status, order_date FROM stg_orders
        WHERE order_status NOT IN ('cancelled', 'canceled')""",
    "flt_exists": """SELECT DISTINCT product_id, product_id IN (SELECT product_id FROM stg_products) AS is_known
        FROM item_ev""",
    "api_daily_revenue": f"SELECT {DAILY_COLUMNS} FROM daily ORDER BY order_date DESC LIMIT 30",
    "api_top_products": f"SELECT * FROM ({TOP}) ORDER BY revenue DESC NULLS LAST, product_id LIMIT 10",
    "api_customer_metrics": f"SELECT * FROM ({METRICS}) ORDER BY total_order_value DESC NULLS LAST, customer_id LIMIT 20",
    "customers_summary": """SELECT count(*) AS customer_count, CAST(sum(order_count) AS BIGINT) AS total_orders,
        CAST(sum(total_order_value) AS DOUBLE) AS total_revenue, CAST(sum(total_units_sold) AS BIGINT) AS total_units,
        CAST(sum(total_order_value) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS average_customer_spend,
        CAST(sum(order_count) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS average_orders_per_customer
        FROM customer_metrics""",
    "customers_by_region": "SELECT region, count(*) AS customer_count FROM dim_customers GROUP BY region",
    "product_details": """SELECT p.product_id, p.product_name, p.category, CAST(p.unit_price AS DOUBLE) AS unit_price,
        p.created_at, p.updated_at,
        CAST(coalesce(sum(CASE WHEN o.order_status NOT IN ('cancelled', 'canceled') THEN i.quantity ELSE 0 END), 0)
            AS BIGINT) AS units_sold,
        CAST(coalesce(sum(CASE WHEN o.order_status NOT IN ('cancelled', 'canceled') THEN i.line_total ELSE 0 END), 0)
            AS DOUBLE) AS revenue,
        count(DISTINCT CASE WHEN o.order_status NOT IN ('cancelled', 'canceled') THEN i.order_id END) AS order_count
        FROM stg_products p LEFT JOIN stg_order_items i ON p.product_id = i.product_id
        LEFT JOIN fact_orders o ON i.order_id = o.order_id GROUP BY ALL""",
    "product_sales_history": """SELECT product_id, order_date, CAST(sum(quantity) AS BIGINT) AS units_sold,
        CAST(sum(line_total) AS DOUBLE) AS revenue, count(DISTINCT order_id) AS order_count
        FROM sold GROUP BY product_id, order_date
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_date DESC) <= 30""",
    "product_recent_orders": """SELECT * FROM (
        SELECT i.product_id, o.order_id, o.customer_id, o.customer_name, o.customer_email,
        o.order_date, o.order_status, CAST(sum(i.quantity) AS BIGINT) AS quantity,
        CAST(sum(i.line_total) AS DOUBLE) AS revenue
        FROM stg_order_items i JOIN fact_orders o ON i.order_id = o.order_id GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_date DESC, order_id DESC) <= 20""",
    "revenue_summary": SUMMARY.format(days="daily"),
    "revenue_summary_30_days": SUMMARY.format(days=LAST_DAYS.format(n=30)),
    "last_n_days": f"SELECT {DAILY_COLUMNS}, {DAILY_AOV} AS average_order_value FROM {LAST_DAYS.format(n=90)}",
    "revenue_trend": f"SELECT {DAILY_COLUMNS}, {DAILY_AOV} AS avg_order_value FROM daily",
    "percent_change": """SELECT order_date, CAST(revenue AS DOUBLE) AS revenue,
        CAST(previous AS DOUBLE) AS previous_revenue,
        CASE WHEN previous IS NULL OR previous = 0 THEN 0.0::DOUBLE
             ELSE (CAST(revenue AS DOUBLE) - CAST(previous AS DOUBLE)) / CAST(previous AS DOUBLE) * 100 END AS revenue_change,
        order_count, previous_count AS previous_order_count,
        CASE WHEN previous_count IS NULL OR previous_count = 0 THEN 0.0::DOUBLE
             ELSE (CAST(order_count AS DOUBLE) - previous_count) / CAST(previous_count AS DOUBLE) * 100 END AS orders_change
        FROM (SELECT *, lag(revenue) OVER (ORDER BY order_date) AS previous,
              lag(order_count) OVER (ORDER BY order_date) AS previous_count FROM daily)
        ORDER BY order_date DESC LIMIT 1""",
    "weekday_averages": """SELECT CAST(d.position AS INTEGER) AS position, d.label,
        coalesce(CAST(sum(revenue) AS DOUBLE) / count(revenue), 0) AS average
        FROM (VALUES (0, 'Sun'), (1, 'Mon'), (2, 'Tue'), (3, 'Wed'), (4, 'Thu'), (5, 'Fri'), (6, 'Sat'))
             AS d(position, label) LEFT JOIN daily ON dayofweek(order_date) = d.position GROUP BY ALL""",
    "category_breakdown": "SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue FROM top_products GROUP BY category",
    "category_shares": """SELECT category, CAST(sum(revenue) AS DOUBLE) AS revenue,
        CAST(sum(revenue) AS DOUBLE) / (SELECT CAST(sum(revenue) AS DOUBLE) FROM top_products) * 100 AS percent
        FROM top_products GROUP BY category""",
    "region_shares": """SELECT region, count(*) AS customer_count,
        CAST(count(*) AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM dim_customers) * 100 AS percent
        FROM dim_customers GROUP BY region""",
    "spend_distribution": _spend(
        [("< R1k", 1000), ("R1k–5k", 5000), ("R5k–15k", 15000), ("R15k–40k", 40000), ("R40k+", None)]
    ),
    "spend_distribution_custom": _spend([("small", 1000000), ("middle", 2500000), ("large", None)]),
    "product_totals": """SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(units_sold) AS BIGINT) AS total_units,
        count(*) AS product_count,
        (SELECT product_name FROM top_products ORDER BY revenue DESC NULLS LAST, product_id LIMIT 1) AS top_product
        FROM top_products""",
    "product_revenue_share": """SELECT row_number() OVER (ORDER BY revenue DESC, product_id) AS position, product_id,
        product_name, category, CAST(revenue AS DOUBLE) AS revenue,
        CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) * 100 AS percent
        FROM (SELECT * FROM top_products ORDER BY revenue DESC, product_id LIMIT 10)""",
    "product_bar_width": """SELECT row_number() OVER (ORDER BY revenue DESC, product_id) AS position, product_id,
        product_name, category, CAST(revenue AS DOUBLE) AS revenue,
        CAST(revenue AS DOUBLE) / CAST(max(revenue) OVER () AS DOUBLE) * 100 AS width
        FROM (SELECT * FROM top_products ORDER BY revenue DESC, product_id LIMIT 5)""",
    "chart_top8": """SELECT product_id, CASE WHEN length(product_name) > 6 THEN substr(product_name, 1, 6) || '…'
        ELSE product_name END AS name, CAST(revenue AS DOUBLE) AS revenue
        FROM top_products ORDER BY revenue DESC, product_id LIMIT 8""",
    "mon_row_counts": "SELECT table_name, row_count, TIMESTAMP '2001-08-01 00:00:00' AS checked_at FROM row_counts",
    "mon_freshness": f"SELECT * EXCLUDE (source_age) FROM {FRESHNESS}",
    "mon_source_age": f"SELECT table_name, CAST(floor(source_age_seconds / 86400) AS BIGINT) AS age_days FROM {FRESHNESS}",
    "source_order_count": "SELECT count(*) AS order_count FROM stg_orders",
    "mart_populated_check": """SELECT 'customer mart' AS name,
        CASE WHEN count(*) = 0 THEN 'degraded' ELSE 'healthy' END AS status,
        CASE WHEN count(*) = 0 THEN 'The customer mart is empty.' ELSE 'The customer mart is populated.' END AS message,
        CAST(count(*) AS VARCHAR) AS customer_count, CAST(coalesce(sum(total_order_value), 0) AS VARCHAR) AS revenue
        FROM customer_metrics""",
    "order_activity_check": """SELECT 'order intake' AS name,
        CASE WHEN newest IS NULL OR age > 300 THEN 'degraded' ELSE 'healthy' END AS status,
        CASE WHEN newest IS NULL THEN 'There are no orders yet.' WHEN age > 300 THEN 'The newest order is stale.'
             ELSE 'Orders are arriving.' END AS message,
        CAST(n AS VARCHAR) AS orders, CAST(age AS VARCHAR) AS age_seconds
        FROM (SELECT count(*) AS n, max(created_at) AS newest,
                     date_diff('second', max(created_at), TIMESTAMP '2024-01-31') AS age FROM stg_orders)""",
    "st_staleness": """SELECT 'stream' AS name,
        CASE WHEN age > 300 THEN 'degraded' ELSE 'healthy' END AS status,
        CASE WHEN age > 300 THEN 'The newest realtime window is stale.' ELSE 'Realtime windows are being published.' END
            AS message,
        strftime(newest, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(age AS VARCHAR) AS age_seconds
        FROM (SELECT max(window_start) AS newest, date_diff('second', max(window_start), TIMESTAMP '2024-01-31') AS age
              FROM revenue_windows)""",
    "health_summary": f"""SELECT CASE WHEN count(*) FILTER (status = 'unhealthy') > 0 THEN 'unhealthy'
        WHEN count(*) FILTER (status = 'degraded') > 0 THEN 'degraded' ELSE 'healthy' END AS status, count(*) AS total,
        count(*) FILTER (status = 'healthy') AS healthy, count(*) FILTER (status = 'degraded') AS degraded,
        count(*) FILTER (status = 'unhealthy') AS unhealthy FROM ({HEALTH_STATUS})""",
    "layer_status": f"""SELECT layer, CASE coalesce(max(CASE status WHEN 'unhealthy' THEN 2 WHEN 'degraded' THEN 1 ELSE 0 END), 0)
        WHEN 2 THEN 'unhealthy' WHEN 1 THEN 'degraded' ELSE 'healthy' END AS status
        FROM (VALUES ('batch', 'Batch'), ('speed', 'Speed'), ('serving', 'Serving')) AS w(layer, word)
        LEFT JOIN ({HEALTH_STATUS}) c ON contains(c.name, w.word) GROUP BY layer""",
    "failed_root_tasks": """SELECT strftime(ts, '%Y-%m-%d %H') AS run_id,
        string_agg(DISTINCT CASE WHEN event_type = 'error' THEN 'task_' || (event_id % 7) END, ', '
            ORDER BY CASE WHEN event_type = 'error' THEN 'task_' || (event_id % 7) END) AS failed_task
        FROM ev GROUP BY 1""",
    "dq_not_null": "SELECT payment_id, payment_status FROM stg_payments WHERE paid_at IS NULL",
    "dq_unique": """SELECT order_item_id AS value, count(*) AS n_records FROM stg_order_items
        GROUP BY 1 HAVING count(*) > 1""",
    "dq_relationships": """SELECT product_id AS value, count(*) AS n_records FROM item_ev
        WHERE product_id NOT IN (SELECT product_id FROM stg_products) GROUP BY 1""",
    "dq_accepted_values": """SELECT order_status AS value, count(*) AS n_records FROM stg_orders
        WHERE order_status NOT IN ('cancelled', 'paid', 'placed', 'shipped') GROUP BY 1""",
    "dq_no_future_orders": f"SELECT order_id, order_ts, order_date FROM {_violations('no_future_orders')}",
    "dq_nonneg_customer_order_counts": f"SELECT customer_id, order_count FROM {_violations('nonneg_customer_order_counts')}",
    "dq_nonneg_line_totals": f"""SELECT order_item_id, CAST(line_total AS DOUBLE) AS line_total
        FROM {_violations('nonneg_line_totals')}""",
    "dq_nonneg_order_counts": f"SELECT order_date, order_count FROM {_violations('nonneg_order_counts')}",
    "dq_nonneg_item_prices": f"""SELECT order_item_id, CAST(unit_price AS DOUBLE) AS unit_price
        FROM {_violations('nonneg_item_prices')}""",
    "dq_nonneg_payments": f"SELECT payment_id, CAST(amount AS DOUBLE) AS amount FROM {_violations('nonneg_payments')}",
    "dq_nonneg_product_prices": f"""SELECT product_id, CAST(unit_price AS DOUBLE) AS unit_price
        FROM {_violations('nonneg_product_prices')}""",
    "dq_nonneg_revenue": f"SELECT order_date, CAST(revenue AS DOUBLE) AS revenue FROM {_violations('nonneg_revenue')}",
    "dq_nonneg_units_sold": f"SELECT product_id, units_sold FROM {_violations('nonneg_units_sold')}",
    "dq_orders_have_items": f"SELECT order_id FROM {_violations('orders_have_items')}",
    "dq_payment_reconciliation": f"""SELECT order_id, CAST(order_value AS DOUBLE) AS order_value,
        CAST(successful_payment_amount AS DOUBLE) AS successful_payment_amount
        FROM {_violations('payment_reconciliation')}""",
    "dq_positive_quantities": f"SELECT order_item_id, quantity FROM {_violations('positive_quantities')}",
    "dq_revenue_matches_items": f"""SELECT order_id, CAST(order_value AS DOUBLE) AS order_value,
        CAST(again AS DOUBLE) AS calculated_order_value FROM {_violations('revenue_matches_items')}""",
    "dq_min_row_counts": f"SELECT table_name, row_count FROM {_violations('min_row_counts')}",
    "dq_success_has_paid_at": f"""SELECT payment_id, order_id, payment_status, paid_at
        FROM {_violations('success_has_paid_at')}""",
    "dq_unpaid_has_no_paid_at": f"SELECT payment_id, payment_status, paid_at FROM {_violations('unpaid_has_no_paid_at')}",
    "dq_report": _report(),
    "rt_revenue_by_minute": "SELECT * FROM revenue_windows",
    "rt_top_products_5min": "SELECT * FROM product_windows",
    "rt_top20": "SELECT * FROM product_windows ORDER BY revenue DESC, window_start, product_id LIMIT 20",
    "rt_live_top_products": """SELECT * FROM product_windows WHERE window_start = (SELECT max(window_start) FROM product_windows)
        ORDER BY revenue DESC, product_id LIMIT 20""",
    "api_rt_top_products": """SELECT coalesce(product_name, 'product-' || product_id) AS product_name,
        round(revenue, 2) AS revenue FROM product_windows ORDER BY product_windows.revenue DESC, window_start, product_id
        LIMIT 10""",
    "rt_latest_revenue": "SELECT * FROM revenue_windows ORDER BY window_start DESC LIMIT 1",
    "rt_window_series": "SELECT window_start, order_count FROM revenue_windows ORDER BY window_start DESC LIMIT 60",
    "rt_history": """SELECT poll_seq, window_start, order_count, revenue FROM (
        SELECT *, lag(window_start) OVER (ORDER BY poll_seq) AS previous FROM (
            SELECT event_id AS poll_seq, time_bucket(INTERVAL '5 minutes', ts) AS window_start,
                   user_id AS order_count, value AS revenue FROM ev WHERE event_type <> 'error'))
        WHERE previous IS NULL OR previous <> window_start ORDER BY poll_seq DESC LIMIT 20""",
    "stream_static_join": """SELECT i.product_id, i.quantity, i.unit_price, i.line_total, i.event_time, i.window_start,
        p.product_name FROM item_ev i LEFT JOIN stg_products p ON i.product_id = p.product_id""",
    "lambda_today_revenue": """SELECT DATE '2001-08-01' AS order_date, b.order_count AS batch_orders,
        CAST(b.revenue AS DOUBLE) AS batch_revenue, s.window_start, s.order_count AS speed_orders,
        s.revenue AS speed_revenue, b.order_count + s.order_count AS merged_orders,
        round(CAST(b.revenue AS DOUBLE) + s.revenue, 2) AS merged_revenue
        FROM (SELECT coalesce(max(order_count), 0) AS order_count, coalesce(max(revenue), 0) AS revenue
              FROM daily WHERE order_date = DATE '2001-08-01') b,
             (SELECT * FROM revenue_windows ORDER BY window_start DESC LIMIT 1) s""",
    "compact_latest": "SELECT * FROM latest_staged",
    "sink_compact_upsert": """SELECT window_start, order_count, revenue, TIMESTAMP '2024-01-31 00:00:00' AS updated_at
        FROM latest_staged""",
    "sink_upsert": """SELECT coalesce(p.product_id, n.product_id) AS product_id, p.product_name,
        coalesce(n.unit_price, CAST(p.unit_price AS DOUBLE)) AS unit_price,
        CASE WHEN p.product_id IS NULL THEN n.event_time ELSE p.updated_at END AS updated_at
        FROM stg_products p FULL JOIN (
            SELECT product_id, unit_price, event_time FROM item_ev
            QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_time DESC) = 1) n
        ON p.product_id = n.product_id""",
    "sink_run_log": f"""SELECT 'run-' || coalesce(o.user_id, n.user_id) AS run_id,
        CASE WHEN o.user_id IS NULL THEN 'error_runs' ELSE 'signup_runs' END AS dag_id,
        CASE WHEN n.user_id IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status,
        coalesce(o.ts, n.ts) AS started_at, coalesce(n.ts, o.ts) AS finished_at,
        CASE WHEN n.user_id IS NOT NULL THEN 'task_' || (n.event_id % 5) END AS failed_task,
        CASE WHEN n.user_id IS NULL THEN o.ts ELSE TIMESTAMP '2024-01-31 00:00:00' END AS recorded_at
        FROM ({_run_outcomes('signup')}) o FULL JOIN ({_run_outcomes('error')}) n ON o.user_id = n.user_id""",
    "st_live_revenue": "SELECT * FROM revenue_windows",
    "st_live_top_products": "SELECT * FROM product_windows",
    "st_speed_layer": """SELECT 'revenue' AS kind, count(*) AS rows,
        CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM revenue_windows
        UNION ALL SELECT 'products', count(*), CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) FROM product_windows""",
    "compact_realtime": """SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS updated_at, CAST(0 AS BIGINT) AS left_in_staging
        FROM revenue_windows""",
    "rt_served_revenue": """SELECT * FROM (SELECT window_start, order_count, 'latest' AS kind FROM revenue_windows
            ORDER BY window_start DESC LIMIT 1)
        UNION ALL SELECT * FROM (SELECT window_start, order_count, 'series' FROM revenue_windows
            ORDER BY window_start DESC LIMIT 60)""",
    "rt_served_products": """SELECT coalesce(product_name, 'product-' || product_id) AS product_name,
        round(revenue, 2) AS revenue FROM product_windows
        WHERE window_start = (SELECT max(window_start) FROM product_windows) ORDER BY revenue DESC, product_id LIMIT 10""",
    "sink_top_products": """SELECT * FROM product_windows WHERE window_start = (SELECT max(window_start) FROM product_windows)
        ORDER BY revenue DESC, product_id LIMIT 20""",
    "st_late_accounts": f"""SELECT count(*) AS events, CAST(0 AS BIGINT) AS rejected, count(*) FILTER (late) AS late,
        count(*) FILTER (NOT late) AS published, count(*) FILTER (NOT late) AS in_totals FROM ({LATE})""",
    "st_late_payments": f"""SELECT payment_id, order_id, amount, event_time, window_start FROM ({LATE}) WHERE late""",
    "lambda_published_runs": """SELECT DATE '2024-01-31' AS order_date, kind,
        count(DISTINCT order_id) FILTER (held AND today) AS batch_orders,
        CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (held AND today), 0) AS DOUBLE) AS batch_revenue,
        max(CASE WHEN kind = 'before' THEN w.window_start END) AS window_start,
        max(CASE WHEN kind = 'before' THEN w.order_count ELSE 0 END) AS speed_orders,
        max(CASE WHEN kind = 'before' THEN w.revenue ELSE 0 END) AS speed_revenue,
        batch_orders + speed_orders AS merged_orders, round(batch_revenue + speed_revenue, 2) AS merged_revenue
        FROM (SELECT *, event_time <= until AS held, CAST(event_time AS DATE) = DATE '2024-01-31' AS today
              FROM pay, (VALUES ('before', TIMESTAMP '2024-01-30 12:00:00'), ('overlap', TIMESTAMP '2024-01-31 00:00:00')) AS t(kind, until)),
             (SELECT * FROM revenue_windows ORDER BY window_start DESC LIMIT 1) w
        GROUP BY kind""",
    "src_cdc_stream": "SELECT payment_id, order_id, amount, event_time FROM pay",
    "src_as_of_customers": """SELECT customer_id, full_name, email, country, signup_date,
        CAST(signup_date AS TIMESTAMP) AS created_at, CAST(signup_date AS TIMESTAMP) AS updated_at FROM raw_customers""",
    "src_as_of_products": """SELECT p_partkey AS product_id, ' ' || p_name AS product_name, p_type || ' ' AS category,
        CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
        TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' AS updated_at FROM part""",
    "src_as_of_orders": """SELECT order_id, customer_id, order_status, order_ts, order_ts AS created_at, order_ts AS updated_at
        FROM raw_orders""",
    "src_as_of_order_items": """SELECT order_item_id, order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(line_total AS DOUBLE) AS line_total, created_at FROM stg_order_items
        QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY order_id DESC, product_id DESC, quantity DESC,
            unit_price DESC, line_total DESC, created_at DESC) = 1""",
    "src_as_of_payments": """SELECT payment_id, order_id, CAST(amount AS DOUBLE) AS amount,
        CASE payment_method WHEN 'card' THEN 'Card' WHEN 'eft' THEN ' EFT' ELSE payment_method END AS payment_method,
        CASE payment_status WHEN 'success' THEN 'Success' WHEN 'failed' THEN ' failed' ELSE payment_status END AS payment_status,
        paid_at, created_at FROM stg_payments""",
    "flt_point_lookup": "SELECT product_id FROM stg_products WHERE product_id IN (7, -1)",
    "src_cdc_damaged": """SELECT 'payments' AS kind, count(*) AS rows,
            count(*) FILTER (event_id % 50 = 0 OR event_id % 13 = 0) AS at_processing_time
        FROM ev WHERE event_type IN ('purchase', 'click') AND event_id % 11 <> 0
        UNION ALL SELECT 'unreadable', count(*), NULL FROM ev WHERE event_id % 11 = 0""",
    "st_closed_revenue": """SELECT * FROM revenue_windows
        WHERE window_start + INTERVAL '1 minute' <= (SELECT max(event_time) - INTERVAL '2 minutes' FROM pay)""",
}

for _name in ("product_details", "product_sales_history", "product_recent_orders"):
    FINAL[f"{_name}_one"] = f"SELECT * FROM ({FINAL[_name]}) WHERE product_id = 7"

for _name in ("fact_orders", "daily_revenue", "top_products", "customer_metrics"):
    FINAL[f"inc_{_name}"] = FINAL[_name if _name == "fact_orders" else f"mart_{_name}"]

FINAL["sink_latest_window"] = FINAL["rt_latest_revenue"]
FINAL["src_published_marts"] = FINAL["api_top_products"]
FINAL["dq_report_bucketed"] = FINAL["dq_report"]
FINAL["flt_stored_lookup"] = f"""SELECT 'product' AS kind, product_id AS id, units_sold AS n
    FROM ({FINAL["mart_top_products"]}) WHERE product_id = 7
    UNION ALL SELECT 'customer', customer_id, order_count FROM ({FINAL["mart_customer_metrics"]}) WHERE customer_id = 7"""

ORACLE = {name: SHARED + final for name, final in FINAL.items()}
