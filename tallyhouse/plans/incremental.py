"""Incremental refresh of the layers: only what changed since the last run is computed and written.

Every table is a set of partitions, and a run's manifest says in which folder each of them is. The large tables
(orders, items, payments, the order fact, revenue by day and two roll-ups) have a partition for each month of the order;
items and payments lie with their order, and the payment fact is the payments with other columns. A run takes the rows
that were inserted, updated or deleted since the last one, derives from them the touched orders, days, customers and
products, and writes new folders for the months that hold touched orders; its manifest names the former folders for all
other months. Then it is published by the pointer (``plans.versions``), so readers see the old tables or the new ones.

The marts over all months are sums of roll-ups that merge exactly: sales per day and product, and orders per month
and customer. Only the touched days, the products sold on them and the touched customers are summed again; the others
are copied.

The five tables have primary keys (the checks of a run assert them), and a change holds the newest row of a key; a row
with a true ``_deleted`` goes. Names of regions are read anew in each run. The first run is the same as any other, on
empty tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import marts, orders, staging
from tallyhouse.operators.upsert import delete_folder, list_folder, read_current, replace_table
from tallyhouse.plans import versions
from tallyhouse.session import most_broadcast, only_measured, settings, side_by_side

KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
}
STAGING = {
    "customers": staging.stg_customers,
    "products": staging.stg_products,
    "orders": staging.stg_orders,
    "order_items": staging.stg_order_items,
    "payments": staging.stg_payments,
}
# Rows whose order is unknown lie in a partition of their own; tables without months have one partition.
NO_MONTH, WHOLE = "none", "all"
MANIFEST = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("part", T.StringType()), T.StructField("folder", T.StringType())]
)
# The month by which a table is laid out, and the column that carries it in tables without the order's date.
PART, MONTH = "_part", "order_month"
# Every run writes its tables anew for the touched months; smaller than Spark's own choice.
CODEC = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def month_of(day: Column | str) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


def read_manifest(spark: SparkSession, folder: str) -> dict[str, dict[str, str]]:
    """Table and partition to folder, of one run; as many rows as there are tables and months."""
    tables: dict[str, dict[str, str]] = {}
    for row in read_current(spark, f"{folder}/manifest", MANIFEST).collect():
        tables.setdefault(row["table"], {})[row["part"]] = row["folder"]
    return tables


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table or a mart of the newest published run."""
    parts = read_manifest(spark, versions.current(spark, root)).get(name, {})
    if not parts:
        raise LookupError(f"no rows of {name} have been published under {root}")
    return spark.read.parquet(*sorted(parts.values()))


class Refresh:
    """One run: ``changes`` has raw rows by table name, of those tables that have any."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, changes: Mapping[str, DataFrame], region_seed: DataFrame):
        self.spark = spark
        # Written tables with so few rows that a join may broadcast their keys.
        self.most, self.small = most_broadcast(spark), set()
        self.folder = versions.new_version(root, run_id)
        runs = versions.published(spark, root)
        self.before = read_manifest(spark, runs[0]["folder"]) if runs else {}
        self.opened: dict[tuple, DataFrame] = {}
        self.manifest = {name: dict(parts) for name, parts in self.before.items()}
        missing = [name for name in KEYS if name not in changes and name not in self.before]
        if missing:
            raise ValueError(f"the first run needs all tables, not {missing}")
        names = [name for name in KEYS if name in changes]
        cleaned = [partial(self._cleaned, name, changes[name]) for name in names]
        self.regions, *changed = side_by_side(lambda: self.kept("regions", region_seed), *cleaned)
        self.changed = dict(zip(names, changed))

    def _cleaned(self, name: str, raw: DataFrame) -> DataFrame:
        """Changed rows through the staging model, with ``_deleted``, written once."""
        gone = F.coalesce(F.col("_deleted"), F.lit(False)) if "_deleted" in raw.columns else F.lit(False)
        both = [STAGING[name](raw.filter(gone == deleted)).withColumn("_deleted", F.lit(deleted)) for deleted in (False, True)]
        return self.kept(f"changed_{name}", both[0].unionByName(both[1]) if "_deleted" in raw.columns else both[0])

    # --- stored tables ---

    def stored(self, name: str, like: DataFrame | None = None, months: Sequence[str] | None = None, before: bool = True) -> DataFrame:
        """A table as the former run left it, or as this one has written it; all of it or some months.

        ``like`` has the columns, for a table that may have no partition yet."""
        parts = (self.before if before else self.manifest).get(name, {})
        folders = sorted(folder for part, folder in parts.items() if months is None or part in months)
        if like is None:
            like = self.spark.read.parquet(next(iter(parts.values())))
        if not folders:
            return self.spark.createDataFrame([], like.schema)
        # Folders never change, so they are listed once.
        key = (name, *folders)
        if key not in self.opened:
            self.opened[key] = self.spark.read.schema(like.schema).parquet(*folders)
        return self.opened[key]

    def write(self, name: str, rows: DataFrame, months: Sequence[str] | None = None, month: Column | str | None = None) -> None:
        """Replace some months of a table, or the whole of one without months; the manifest follows.

        ``month`` may be a column of the rows, which then is shuffled once and not beside a copy of itself."""
        path = f"{self.folder}/{name}"
        parts = self.manifest.setdefault(name, {})
        if months is None:
            rows.write.parquet(f"{path}/{PART}={WHOLE}", compression=CODEC)
            parts[WHOLE] = f"{path}/{PART}={WHOLE}"
            return
        if isinstance(month, str):
            laid_out = rows.hint("rebalance", month).withColumn(PART, F.col(month))
        else:
            laid_out = rows.withColumn(PART, month).hint("rebalance", PART)
        laid_out.write.partitionBy(PART).parquet(path, compression=CODEC)
        for old in months:
            parts.pop(old, None)
        written = [f for f in list_folder(self.spark, path) if f.startswith(f"{PART}=")]
        parts |= {f.partition("=")[2]: f"{path}/{f}" for f in written}
        if not parts:
            # The columns of an empty table are known to later runs.
            self.write(name, rows.filter(F.lit(False)))

    def kept(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows, computed once and written beside the tables."""
        path = f"{self.folder}/work/{name}"
        rows.write.parquet(path, compression=CODEC)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        if stored.count() <= self.most:
            self.small.add(stored)
        return stored

    # --- joins with kept rows: broadcast by their number, as the size of files tells little of that in memory ---

    def keys(self, kept: DataFrame, *columns: Column | str) -> DataFrame:
        """Columns of kept rows, for the side of a join that is looked up."""
        chosen = kept.select(*columns)
        return F.broadcast(chosen) if kept in self.small else chosen

    def without(self, rows: DataFrame, kept: DataFrame, column: str) -> DataFrame:
        return rows.join(self.keys(kept, column), column, "left_anti")

    def only(self, rows: DataFrame, kept: DataFrame, column: str) -> DataFrame:
        return rows.join(self.keys(kept, column), column, "left_semi")

    def found(self, rows: DataFrame, kept: DataFrame, column: str) -> DataFrame:
        """The same for few keys of a large table: row groups outside the keys' bounds are not read."""
        low, high = kept.agg(F.min(column), F.max(column)).first()
        return self.only(rows.filter(F.col(column).between(F.lit(low), F.lit(high))), kept, column)

    def same_day(self, rows: DataFrame, how: str) -> DataFrame:
        """Rows of the touched days, or the others."""
        days = self.keys(self.days, "order_date")
        return rows.join(days, rows["order_date"].eqNullSafe(days["order_date"]), how)

    def overlaid(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows of a source table with the changes of the run in place of the old rows of their keys."""
        if name not in self.changed:
            return rows
        fresh = self.changed[name]
        # Changes of items and payments have no month yet.
        return self.without(rows, fresh, KEYS[name]).unionByName(fresh.filter(~F.col("_deleted")).drop("_deleted"), MONTH in rows.columns)

    def source(self, name: str, months: Sequence[str] | None = None) -> DataFrame:
        """A source table as the former run left it."""
        like = None if name in self.before else self.changed[name].drop("_deleted").withColumn(MONTH, F.lit(""))
        rows = self.stored(name, like, months)
        return rows if name in ("order_items", "payments") else rows.drop(MONTH)

    # --- the run ---

    def run(self) -> None:
        """Write all that the changes touch, and the run's manifest."""
        self.touched = self.kept("touched_orders", self._touched_orders())
        self.old_orders = self.kept("old_orders", self.found(self.source("orders"), self.touched, "order_id"))
        # Changed orders with an id are touched.
        changed = self.overlaid("orders", self.old_orders).filter(F.col("order_id").isNotNull())
        self.new_orders = self.kept("new_orders", changed)
        dates = self.old_orders.select("order_date").unionByName(self.new_orders.select("order_date"))
        self.days = self.kept("touched_days", dates.distinct())
        # A row for each month; rows whose order is unknown may get one, and the other way round.
        found = [row[0] for row in self.days.select(month_of("order_date")).distinct().collect()]
        self.months = sorted({*found, NO_MONTH})
        _, items, payments, customers, products = side_by_side(
            self._orders,
            lambda: self._of_orders("order_items"),
            lambda: self._of_orders("payments"),
            lambda: self._whole("customers"),
            lambda: self._whole("products"),
        )
        self._facts(items, payments, customers)
        side_by_side(lambda: self._sales(products), self._daily, lambda: self._customers(customers))
        rows = [(table, part, folder) for table, parts in self.manifest.items() for part, folder in parts.items()]
        replace_table(self.spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{self.folder}/manifest", MANIFEST)

    def _touched_orders(self) -> DataFrame:
        """Orders that changed, or an item, a payment or the customer of which changed, as they are or were."""
        ids = [self.changed[name].select("order_id") for name in ("orders", "order_items", "payments") if name in self.changed]
        for name in ("order_items", "payments"):
            if name in self.changed:
                ids.append(self.found(self.source(name), self.changed[name], KEYS[name]).select("order_id"))
        if "customers" in self.changed:
            ids.append(self.only(self.source("orders"), self.changed["customers"], "customer_id").select("order_id"))
        if not ids:
            return self.source("orders").select("order_id").filter(F.lit(False))
        return reduce(DataFrame.unionByName, ids).filter(F.col("order_id").isNotNull()).distinct()

    def _orders(self) -> None:
        same = self.without(self.source("orders", self.months), self.touched, "order_id")
        self.write("orders", same.unionByName(self.new_orders), self.months, month_of("order_date"))

    def _of_orders(self, name: str) -> DataFrame:
        """Rewrite the items or payments of the touched months, which are returned.

        The changes take the place of the stored rows of their keys. Then rows of touched orders get the month of their
        order as it is now, those of an order that is not there no month, and all others keep theirs."""
        stored = self.source(name, self.months)
        rows = self.overlaid(name, stored)
        now = self.keys(self.new_orders, "order_id", month_of("order_date").alias("_now"))
        touched = self.touched.join(now, "order_id", "left").select("order_id", F.coalesce("_now", F.lit(NO_MONTH)).alias("_now"))
        if self.touched in self.small:
            touched = F.broadcast(touched)
        moved = rows.join(touched, "order_id", "left").withColumn(MONTH, F.coalesce("_now", MONTH, F.lit(NO_MONTH)))
        self.write(name, moved.select(*stored.columns), self.months, MONTH)
        return self.stored(name, stored, self.months, before=False).drop(MONTH)

    def _whole(self, name: str) -> DataFrame:
        """A source table without months, with its changes."""
        rows = self.source(name)
        if name in self.changed:
            self.write(name, self.overlaid(name, rows))
        return self.stored(name, rows, before=False)

    def _facts(self, items: DataFrame, payments: DataFrame, customers: DataFrame) -> None:
        facts = marts.fact_orders(orders.int_orders_enriched(self.new_orders, customers, items, payments))
        same = self.without(self.stored("fact_orders", facts, self.months), self.touched, "order_id")
        self.write("fact_orders", same.unionByName(facts), self.months, month_of("order_date"))
        self.facts = self.stored("fact_orders", facts, self.months, before=False)

    def _by_day(self, name: str, fresh: DataFrame) -> None:
        """Replace the touched days of a table by day."""
        same = self.same_day(self.stored(name, fresh, self.months), "left_anti")
        self.write(name, same.unionByName(fresh), self.months, month_of("order_date"))

    def _daily(self) -> None:
        """Revenue of the touched days."""
        facts = self.same_day(self.facts, "left_semi")
        self._by_day("mart_daily_revenue", marts.mart_daily_revenue(facts))

    def _sales(self, products: DataFrame) -> None:
        """Units and revenue of the touched days per product, then the totals of the products sold on them."""
        facts = self.same_day(self.facts, "left_semi")
        items = self.stored("order_items", self.source("order_items"), self.months, before=False)
        sales = marts.sold_items(items, facts).groupBy("order_date", "product_id")
        fresh = sales.agg(F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("revenue"))
        self._by_day("sales_by_day", fresh)
        both = [self.stored("sales_by_day", fresh, self.months, before=before) for before in (True, False)]
        sold = [self.same_day(rows, "left_semi").select("product_id") for rows in both]
        self._products(products, sold[0].unionByName(sold[1]))

    def _touched(self, name: str, column: str, ids: DataFrame) -> DataFrame:
        if name in self.changed:
            ids = ids.unionByName(self.changed[name].select(column))
        return self.kept(f"touched_{name}", ids.distinct())

    def _products(self, products: DataFrame, ids: DataFrame) -> None:
        """Totals of the products that sold on a touched day, before or now, or whose own row changed."""
        ids = self._touched("products", "product_id", ids)
        self.write("dim_products", marts.dim_products(products))
        sales = self.only(self.stored("sales_by_day", before=False), ids, "product_id")
        fresh = marts.named_products(
            sales.groupBy("product_id").agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")), products
        )
        same = self.without(self.stored("mart_top_products", fresh), ids, "product_id")
        self.write("mart_top_products", same.unionByName(fresh))

    def _customers(self, customers: DataFrame) -> None:
        """Totals of the customers that have or had a touched order, or whose own row changed."""
        ids = self.old_orders.select("customer_id").unionByName(self.new_orders.select("customer_id"))
        ids = self._touched("customers", "customer_id", ids)
        of_month = self.only(self.facts, ids, "customer_id").withColumn(MONTH, month_of("order_date"))
        fresh = orders.orders_per_customer(of_month, MONTH)
        same = self.without(self.stored("orders_by_month", fresh, self.months), ids, "customer_id")
        self.write("orders_by_month", same.unionByName(fresh), self.months, MONTH)
        by_month = self.only(self.stored("orders_by_month", fresh, before=False), ids, "customer_id")
        everyone = marts.dim_customers(customers, self.keys(self.regions, *self.regions.columns))
        self.write("dim_customers", everyone)
        metrics = marts.customer_metrics(self.only(everyone, ids, "customer_id"), orders.add_months(by_month))
        same = self.without(self.stored("mart_customer_metrics", metrics), ids, "customer_id")
        self.write("mart_customer_metrics", same.unionByName(metrics))


def refresh(
    spark: SparkSession,
    root: str,
    run_id: str,
    changes: Mapping[str, DataFrame],
    region_seed: DataFrame,
    high_water: datetime | None = None,
    keep: int = 2,
) -> None:
    """Bring the layers under ``root`` up to date with the changed rows and publish them."""
    run = Refresh(spark, root, run_id, changes, region_seed)
    try:
        # Shuffle files go with the step that wrote them.
        with settings(spark, only_measured(spark) | {CLEANUP: "true"}):
            run.run()
        versions.publish(spark, root, run.folder, high_water)
    except Exception:
        delete_folder(spark, run.folder)
        raise
    delete_folder(spark, f"{run.folder}/work")
    drop_unread(spark, root, keep)


def drop_unread(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove the folders that the manifests of the newest ``keep`` runs do not name."""
    runs = versions.published(spark, root)
    named = {f for run in runs[:keep] for parts in read_manifest(spark, run["folder"]).values() for f in parts.values()}
    for run in runs[keep:]:
        for table in list_folder(spark, run["folder"]):
            if table == "manifest":
                continue
            for part in list_folder(spark, f"{run['folder']}/{table}"):
                if part.startswith(f"{PART}=") and f"{run['folder']}/{table}/{part}" not in named:
                    delete_folder(spark, f"{run['folder']}/{table}/{part}")
    held = {f.rsplit("/", 2)[0] for f in named}
    versions.forget(spark, root, [run["folder"] for run in runs[keep:] if run["folder"] not in held])


def changes_since(raw: Mapping[str, DataFrame], moment: Column) -> dict[str, DataFrame]:
    """The rows that the sources' own time columns put after ``moment``; deletions leave no row there."""
    stamps = {"customers": "updated_at", "products": "updated_at", "orders": "updated_at", "order_items": "created_at"}
    found = {name: raw[name].filter(F.col(stamp) > moment) for name, stamp in stamps.items()}
    paid = F.greatest("created_at", "paid_at")
    return {**found, "payments": raw["payments"].filter(paid > moment)}
