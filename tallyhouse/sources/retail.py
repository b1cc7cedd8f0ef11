"""The five source tables, the region seed and the change streams, as views over a retail star schema.

The star schema has ``region nation customer part orders lineitem events``. Text gets the kind of
noise (case, blanks) the staging layer removes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Money of a double with two decimals.
CENTS = "decimal(10,2)"

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


class LazyTables:
    """Tables by name, each built when it is first asked for."""

    def __init__(self, build: Callable[[str], DataFrame]):
        self.build = build
        self.frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = self.build(name)
        return self.frames[name]


TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")


def star_tables(spark: SparkSession, folder: str) -> LazyTables:
    return LazyTables(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))


def customers(star: LazyTables) -> DataFrame:
    nation = star["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    return (
        star["customer"]
        .join(nation, "c_nationkey")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("full_name"),
            F.concat(F.lit(" "), "c_name", F.lit("@Example.com")).alias("email"),
            F.concat("n_name", F.lit(" ")).alias("country"),
            signup.alias("signup_date"),
            signup.cast("timestamp").alias("created_at"),
            signup.cast("timestamp").alias("updated_at"),
        )
    )


def region_seed(star: LazyTables) -> DataFrame:
    """Region of every country but those of one region, whose customers stay unknown."""
    region = star["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        star["nation"]
        .join(region.filter(F.col("r_name") != "MIDDLE EAST"), "n_regionkey")
        .select(F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    )


def products(star: LazyTables) -> DataFrame:
    listed = F.lit("1995-01-01").cast("timestamp")
    return star["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(" "), "p_name").alias("product_name"),
        F.concat("p_type", F.lit(" ")).alias("category"),
        F.col("p_retailprice").cast(CENTS).alias("unit_price"),
        listed.alias("created_at"),
        listed.alias("updated_at"),
    )


def _order_status() -> Column:
    """Both spellings of a cancelled order occur."""
    low = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return (
        F.when(F.col("o_orderstatus") == "F", " Shipped")
        .when(F.col("o_orderstatus") == "O", "placed")
        .when(low & (F.col("o_orderkey") % 2 == 0), "CANCELLED ")
        .when(low, "canceled")
        .otherwise("Paid")
    )


def orders(star: LazyTables) -> DataFrame:
    placed = F.col("o_orderdate").cast("timestamp")
    return star["orders"].select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _order_status().alias("order_status"),
        placed.alias("order_ts"),
        placed.alias("created_at"),
        placed.alias("updated_at"),
    )


def order_items(star: LazyTables) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    unit_cents = F.floor(cents / F.col("l_quantity"))
    return star["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        (unit_cents / 100).cast(CENTS).alias("unit_price"),
        F.col("l_extendedprice").cast(CENTS).alias("line_total"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )


def payments(star: LazyTables) -> DataFrame:
    status = F.trim(F.lower(_order_status()))
    outcome = (
        F.when(status.isin("paid", "shipped"), "Success").when(status == "placed", "pending").otherwise(" failed")
    )
    method = (
        F.when(F.col("o_custkey") % 3 == 0, "Card").when(F.col("o_custkey") % 3 == 1, " EFT").otherwise("wallet")
    )
    placed = F.col("o_orderdate").cast("timestamp")
    return star["orders"].select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast(CENTS).alias("amount"),
        method.alias("payment_method"),
        outcome.alias("payment_status"),
        F.when(outcome == "Success", placed).alias("paid_at"),
        placed.alias("created_at"),
    )


SOURCES = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
}


def raw_tables(star: LazyTables) -> LazyTables:
    """The five source tables by name."""
    return LazyTables(lambda name: SOURCES[name](star))


# --- change streams -----------------------------------------------------------------------------


def _envelope(after: Column, op: Column) -> Column:
    return F.to_json(
        F.struct(
            after.alias("after"), op.alias("op"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms")
        )
    )


def payment_changes(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event rows as change envelopes of payments (column ``value``); every 50th has no time. ``keep`` names event
    columns that go along."""
    kind = F.col("event_type")
    stamp = F.date_format(F.col("ts").cast("timestamp"), ISO_MICROS)
    after = F.struct(
        F.col("event_id").alias("payment_id"),
        F.col("user_id").alias("order_id"),
        F.col("value").alias("amount"),
        F.lit("card").alias("payment_method"),
        F.when(kind == "error", "failed").otherwise("success").alias("payment_status"),
        F.when(F.col("event_id") % 50 != 0, stamp).alias("paid_at"),
        stamp.alias("created_at"),
    )
    op = (
        F.when(kind.isin("purchase", "error"), "c")
        .when(kind == "click", "u")
        .when(kind == "signup", "r")
        .otherwise("d")
    )
    return events.select(*keep, _envelope(after, op).alias("value"))


def item_changes(events: DataFrame) -> DataFrame:
    """Event rows as change envelopes of order items; every 7th has no line total."""
    after = F.struct(
        F.col("event_id").alias("order_item_id"),
        F.col("event_id").alias("order_id"),
        (F.col("user_id") % 150 - 3).alias("product_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("quantity"),
        F.col("value").alias("unit_price"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("line_total"),
        F.date_format(F.col("ts").cast("timestamp"), ISO_MICROS).alias("created_at"),
    )
    op = F.when(F.col("event_type").isin("purchase", "click"), "c").otherwise("u")
    return events.select(_envelope(after, op).alias("value"))


# --- changes during a snapshot -------------------------------------------------------------------

# For each table: its key, a column that updates change, and how.
UPDATES = {
    "customers": ("customer_id", "full_name", "concat(full_name, '!')"),
    "products": ("product_id", "unit_price", "CAST(unit_price + 1 AS DECIMAL(10,2))"),
    "orders": ("order_id", "order_status", "'returned'"),
    "order_items": ("order_item_id", "quantity", "quantity + 1"),
    "payments": ("payment_id", "payment_status", "'refunded'"),
}


def changes_after(name: str, table: DataFrame) -> DataFrame:
    """Changes of a table in the hours after a moment: (hour, position, op, before, after).

    Every 5th row is updated in the first hour, every 10th again in the third, every 7th is deleted in the second unless it
    was updated, and every 9th gets a new row, with a negative key, in the second hour, which is updated in the third."""
    key, column, sql = UPDATES[name]
    kind = table.schema[column].dataType
    twice = table.withColumn("_once", F.expr(sql).cast(kind)).withColumn("_twice", F.expr(sql.replace(column, "_once")).cast(kind))
    old, once, again = (
        F.struct(*[F.col(source if c == column else c).alias(c) for c in table.columns]) for source in (column, "_once", "_twice")
    )
    nothing = F.lit(None).cast(table.select(F.struct(*table.columns).alias("row")).schema["row"].dataType)

    number = F.col(key)
    new_old, new_once = (image.withField(key, -number) for image in (old, once))
    # Which rows, then position, hour, operation and images.
    kinds = (
        (number % 5 == 0, number, 1, "u", old, once),
        (number % 10 == 0, number, 3, "u", once, again),
        ((number % 7 == 0) & (number % 5 != 0), number, 2, "d", old, nothing),
        (number % 9 == 1, -number, 2, "c", nothing, new_old),
        (number % 9 == 1, -number, 3, "u", new_old, new_once),
    )
    # One pass over the table: a row gives the numbers of its changes, each of which then gets its images.
    numbered = F.explode(F.array(*[F.when(kind[0], F.lit(i)) for i, kind in enumerate(kinds)])).alias("_kind")
    changed = twice.select("*", numbered).filter(F.col("_kind").isNotNull())

    def chosen(field: int, name: str) -> Column:
        values = [kind[field] if isinstance(kind[field], Column) else F.lit(kind[field]) for kind in kinds]
        found = F.when(F.col("_kind") == 0, values[0])
        for i, value in enumerate(values[1:], 1):
            found = found.when(F.col("_kind") == i, value)
        return found.alias(name)

    return changed.select(*[chosen(i, name) for i, name in enumerate(("position", "hour", "op", "before", "after"), 1)])


def scanned_after(name: str, table: DataFrame, hours: int) -> DataFrame:
    """What a scan finds that many hours after the moment, of a table whose keys are unique."""
    before = table.select(F.lit(0).alias("hour"), F.col(UPDATES[name][0]).alias("position"), F.struct(*table.columns).alias("after"))
    seen = before.unionByName(changes_after(name, table).filter(F.col("hour") <= hours).select(*before.columns))
    last = seen.groupBy("position").agg(F.max_by("after", "hour").alias("after"))
    return last.filter(F.col("after").isNotNull()).select("after.*")


def envelopes_of(changes: DataFrame, moment: Column) -> DataFrame:
    """Changes as envelopes with both images: (position, value)."""
    at = F.unix_millis(moment) + F.col("hour") * 3_600_000
    return changes.select("position", F.to_json(F.struct("before", "after", "op", at.alias("ts_ms"))).alias("value"))


# --- violations -----------------------------------------------------------------------------------

# For each rule that the tables keep: a table, and a column of it that is spoiled in some rows.
SPOILED = {
    "nonneg_customer_order_counts": ("mart_customer_metrics", "order_count", "IF(customer_id % 97 = 0, -1, order_count)"),
    "nonneg_line_totals": ("stg_order_items", "line_total", "IF(order_item_id % 97 = 0, -line_total, line_total)"),
    "nonneg_order_counts": ("mart_daily_revenue", "order_count", "IF(day(order_date) = 13, -order_count, order_count)"),
    "nonneg_item_prices": ("stg_order_items", "unit_price", "IF(order_item_id % 97 = 0, -unit_price, unit_price)"),
    "nonneg_payments": ("stg_payments", "amount", "IF(payment_id % 97 = 0, -amount, amount)"),
    "nonneg_product_prices": ("stg_products", "unit_price", "IF(product_id % 97 = 0, -unit_price, unit_price)"),
    "nonneg_revenue": ("mart_daily_revenue", "revenue", "IF(day(order_date) = 13, -1 - revenue, revenue)"),
    "nonneg_units_sold": ("mart_top_products", "units_sold", "IF(product_id % 97 = 0, -units_sold, units_sold)"),
    "positive_quantities": ("stg_order_items", "quantity", "IF(order_item_id % 97 = 0, 0, quantity)"),
    "revenue_matches_items": ("fact_orders", "order_value", "IF(order_id % 97 = 0, order_value + 1, order_value)"),
    "success_has_paid_at": ("stg_payments", "paid_at", "IF(payment_id % 97 = 0, NULL, paid_at)"),
    "unpaid_has_no_paid_at": ("stg_payments", "paid_at", "IF(payment_id % 97 = 0, created_at, paid_at)"),
}
