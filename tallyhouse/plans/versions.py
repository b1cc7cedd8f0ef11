"""Versions of the batch layers.

A run writes raw tables and marts into a folder of its own and checks them there. Publishing replaces the small table
of published runs (``operators.upsert.replace_table``); readers follow its newest row, so they see the layers of one
checked run, never a mixture, and a run that fails leaves them where they were. One run publishes at a time.

With a run goes its high-water mark: the moment up to which the speed layer's events are in its layers.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T

from tallyhouse.operators.upsert import delete_folder, folder_times, read_current, replace_table

PUBLISHED = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("high_water", T.TimestampType()),
    ]
)
# Folders of runs that neither published nor failed by themselves go after this time.
ABANDONED_HOURS = 24


def new_version(root: str, run_id: str) -> str:
    """A folder nobody reads yet."""
    return f"{root.rstrip('/')}/versions/{run_id}-{uuid.uuid4().hex}"


def published(spark: SparkSession, root: str) -> list[Row]:
    """The runs that have been published and not dropped since, the newest first."""
    rows = read_current(spark, f"{root.rstrip('/')}/published", PUBLISHED).collect()
    return sorted(rows, key=lambda row: -row["number"])


def newest(spark: SparkSession, root: str) -> Row:
    runs = published(spark, root)
    if not runs:
        raise LookupError(f"nothing has been published under {root}")
    return runs[0]


def current(spark: SparkSession, root: str) -> str:
    return newest(spark, root)["folder"]


def _write(spark: SparkSession, root: str, runs: list) -> None:
    table = spark.createDataFrame([tuple(run) for run in runs], PUBLISHED).coalesce(1)
    replace_table(table, f"{root.rstrip('/')}/published", PUBLISHED)


def publish(spark: SparkSession, root: str, folder: str, high_water: datetime | None = None) -> None:
    runs = published(spark, root)
    number = runs[0]["number"] + 1 if runs else 1
    _write(spark, root, [(number, folder, high_water), *runs])


def forget(spark: SparkSession, root: str, folders: list[str]) -> None:
    """Remove some published runs."""
    runs = published(spark, root)
    if folders:
        _write(spark, root, [run for run in runs if run["folder"] not in folders])
        for folder in folders:
            delete_folder(spark, folder)


def drop_old(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove the layers of all published runs but the newest ``keep``, and of runs that were abandoned.

    The version before the current one stays for readers that have begun on it; runs in progress are spared."""
    runs = published(spark, root)
    if len(runs) > keep:
        _write(spark, root, runs[:keep])
        for run in runs[keep:]:
            delete_folder(spark, run["folder"])
    wanted = {run["folder"].rsplit("/", 1)[1] for run in runs[:keep]}
    versions = f"{root.rstrip('/')}/versions"
    now = datetime.now(timezone.utc).timestamp()
    for name, changed in folder_times(spark, versions).items():
        if name not in wanted and now - changed > ABANDONED_HOURS * 3600:
            delete_folder(spark, f"{versions}/{name}")
