"""Keyed updates of stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import date
from functools import partial, reduce
from itertools import batched, chain

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows sent to the database per statement batch.
UPSERT_BATCH = 1_000


def keyed_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str]
) -> DataFrame:
    """Insert rows with new keys; on known keys change ``update_columns`` and keep the others.

    ``updates`` holds one row per key (see ``latest_per_key``). The result has the target's columns
    and types; columns missing from ``updates`` are NULL on inserted rows.
    """
    types = dict(target.dtypes)
    old = target.withColumn("_stored", F.lit(True))
    new = updates.withColumn("_updated", F.lit(True))
    same_key = [F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")) for key in keys]
    joined = old.alias("old").join(new.alias("new"), same_key, "full_outer")
    inserted = F.col("old._stored").isNull()
    updated = F.col("new._updated").isNotNull()

    def value(name: str) -> Column:
        if name not in updates.columns:
            return F.col(f"old.{name}")
        fresh = F.col(f"new.{name}").cast(types[name])
        takes_new = updated if name in update_columns else inserted
        return F.when(takes_new, fresh).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(*[value(name) for name in target.columns])


def latest_per_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key of an append-only log; of equally new ones the greatest by the other columns.

    A rank, of which every task sends on only its own first row per key. The key's rows are sorted, before the
    shuffle and, what is left of them, after it; a hash aggregate cannot hold whole rows as its state.
    """
    others = [name for name in log.columns if name not in keys and name not in order]
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(name) for name in [*order, *others]])
    ranked = log.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).select(*keys, *[name for name in log.columns if name not in keys])


def compact_latest(staging: DataFrame) -> DataFrame:
    """One row per window: the one ingested last."""
    return latest_per_key(staging, ["window_start"], ["ingested_at"])


def compact_upsert(current: DataFrame, staging: DataFrame, now: Column | None = None) -> DataFrame:
    """The window table after folding the staging log into it."""
    stamped = (
        compact_latest(staging)
        .select("window_start", "order_count", "revenue")
        .withColumn("updated_at", F.current_timestamp() if now is None else now)
    )
    return keyed_upsert(current, stamped, ["window_start"], ["order_count", "revenue", "updated_at"])


def record_run(log: DataFrame, outcome: DataFrame, now: Column | None = None) -> DataFrame:
    """Upsert run outcomes by ``run_id``; the first ``started_at`` and ``dag_id`` stay."""
    stamped = outcome.withColumn("recorded_at", F.current_timestamp() if now is None else now)
    return keyed_upsert(log, stamped, ["run_id"], ["status", "finished_at", "failed_task", "recorded_at"])


# --- stored tables ------------------------------------------------------------------------------


def _hadoop(spark: SparkSession, path: str):
    """File system and path objects of the cluster's own storage layer."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    fs, where = _hadoop(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(where)] if fs.exists(where) else []


def folder_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder and when they were last changed, in seconds."""
    fs, where = _hadoop(spark, path)
    entries = fs.listStatus(where) if fs.exists(where) else []
    return {entry.getPath().getName(): entry.getModificationTime() / 1000 for entry in entries}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder, 0 if it does not exist."""
    fs, where = _hadoop(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def overwrite_partitions(frame: DataFrame, path: str, *partitions: str) -> None:
    """Replace only those partitions of ``path`` that ``frame`` has rows for."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


# Versions of a small table that stay: the current one, and those that a reader may still be on.
KEPT_VERSIONS = 3


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of a small table, the oldest first: a write ends with its success file."""
    return [name for name in sorted(list_folder(spark, path)) if table_exists(spark, f"{path}/{name}/_SUCCESS")]


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of a small table, empty if there is none. It stays readable while it is replaced."""
    versions = _versions(spark, path)
    return read_or_empty(spark, f"{path}/{versions[-1]}", schema) if versions else spark.createDataFrame([], schema)


def replace_table(frame: DataFrame, path: str, schema: T.StructType) -> None:
    """Write a new version of a small table; readers see the former one until the write is complete.

    ``frame`` may be made from the current version. A write that is cut off is no version."""
    spark = frame.sparkSession
    versions = _versions(spark, path)
    number = int(versions[-1].split("-")[0]) + 1 if versions else 0
    frame.select(*schema.names).write.parquet(f"{path}/{number:012d}-{uuid.uuid4().hex}")
    for old in versions[: 1 - KEPT_VERSIONS]:
        delete_folder(spark, f"{path}/{old}")


def upsert_small_table(
    updates: DataFrame, path: str, keys: Sequence[str], update_columns: Sequence[str], schema: T.StructType
) -> None:
    """Upsert into a stored table that is rewritten as a whole, such as the run log."""
    current = read_current(updates.sparkSession, path, schema)
    replace_table(keyed_upsert(current, updates, keys, update_columns), path, schema)


# Where the rows of each day are: one row a day, a small table with versions.
DAYS = T.StructType([T.StructField("window_date", T.DateType()), T.StructField("folder", T.StringType())])


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None) -> DataFrame:
    """A stored table of windows, or some days of it; only their folders are read."""
    listed = {r["window_date"]: r["folder"] for r in read_current(spark, f"{path}/days", DAYS).collect()}
    folders = [folder for day, folder in sorted(listed.items()) if days is None or day in days]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def replace_days(frame: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace the days that ``frame`` has windows of; the others are not read.

    The new days go to folders of their own, then the table of days is replaced, so a reader sees all old days or all
    new ones, and a run that is cut off has changed nothing. ``frame`` may be made from the days it replaces."""
    spark = frame.sparkSession
    folder = f"{path}/data/{uuid.uuid4().hex}"
    dated = frame.select(*schema.names, F.to_date("window_start").alias("window_date"))
    dated.hint("rebalance", "window_date").write.partitionBy("window_date").parquet(folder)
    written = [name for name in list_folder(spark, folder) if name.startswith("window_date=")]
    listed = {r["window_date"]: r["folder"] for r in read_current(spark, f"{path}/days", DAYS).collect()}
    listed |= {date.fromisoformat(name.partition("=")[2]): f"{folder}/{name}" for name in written}
    replace_table(spark.createDataFrame(sorted(listed.items()), DAYS), f"{path}/days", DAYS)
    _drop_replaced_days(spark, path)


def _drop_replaced_days(spark: SparkSession, path: str) -> None:
    """Remove the day folders that no kept version of the table of days names."""
    kept = [read_or_empty(spark, f"{path}/days/{version}", DAYS) for version in _versions(spark, f"{path}/days")]
    named = {r["folder"].removeprefix(f"{path}/data/") for r in reduce(DataFrame.unionByName, kept).collect()}
    for run in list_folder(spark, f"{path}/data"):
        days = [name for name in list_folder(spark, f"{path}/data/{run}") if name.startswith("window_date=")]
        unread = [day for day in days if f"{run}/{day}" not in named]
        # A folder without a success file may be one that another run is writing.
        if table_exists(spark, f"{path}/data/{run}/_SUCCESS") and len(unread) == len(days):
            delete_folder(spark, f"{path}/data/{run}")
        elif table_exists(spark, f"{path}/data/{run}/_SUCCESS"):
            for day in unread:
                delete_folder(spark, f"{path}/data/{run}/{day}")


def drop_batches(spark: SparkSession, path: str, folded: Sequence[tuple[str, int]]) -> None:
    """Remove the folders of the given (generation, batch_id) from a staging log; others stay."""
    for generation, batch_id in folded:
        delete_folder(spark, f"{path}/generation={generation}/batch_id={batch_id}")


# --- relational targets ---------------------------------------------------------------------------


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], update_columns: Sequence[str]) -> str:
    def listed(names: Sequence[str]) -> str:
        return ", ".join(f'"{name}"' for name in names)

    changes = ", ".join(f'"{name}" = EXCLUDED."{name}"' for name in update_columns)
    action = f"UPDATE SET {changes}" if changes else "NOTHING"
    marks = ", ".join(["%s"] * len(columns))
    return (
        f"INSERT INTO {table} ({listed(columns)}) VALUES ({marks}) "
        f"ON CONFLICT ({listed(keys)}) DO {action}"
    )


def _upsert_partition(rows: Iterator[Row], connect: Callable, statement: str) -> None:
    batches = batched(rows, UPSERT_BATCH)
    first = next(batches, None)
    if first is None:
        return
    connection = connect()
    try:
        cursor = connection.cursor()
        for batch in chain([first], batches):
            cursor.executemany(statement, [tuple(row) for row in batch])
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert_jdbc(
    frame: DataFrame, connect: Callable, table: str, keys: Sequence[str], update_columns: Sequence[str]
) -> None:
    """Upsert into a relational table from the executors, one transaction per partition.

    ``connect`` returns a DB-API connection and is called on the executors. A retried task sends the
    same rows again, which an upsert absorbs. ``frame`` holds one row per key.
    """
    statement = upsert_statement(table, frame.columns, keys, update_columns)
    frame.foreachPartition(partial(_upsert_partition, connect=connect, statement=statement))
