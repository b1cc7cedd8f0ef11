"""Tables as of one moment, from scans at different moments and the change log.

A scan of a running source holds whatever had been committed when it came by, so five scans one after the other do not
belong together. The change log names, for every change, the row before it; so the first change of a key after the
wanted moment says what the row was at that moment, whether the scan has seen the change or not. Rows that were not
there yet go, deleted rows come back, all others are the scan's.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import side_by_side
from tallyhouse.sources.cdc import parse_images
from tallyhouse.sources.tables import load_raw, read_layer


def first_changes(images: DataFrame, key: str, moment: Column) -> DataFrame:
    """(key, before) of each key's first change after the moment; ``images`` has before, after, at and position.

    Of changes at the same time the one of the smaller position comes first. One row per key is kept in every task."""
    later = images.filter(F.col("at") > moment)
    named = later.select(F.coalesce(f"after.{key}", f"before.{key}").alias(key), "before", "at", "position")
    return named.groupBy(key).agg(F.min_by("before", F.struct("at", "position")).alias("before"))


def as_of(scan: DataFrame, images: DataFrame, key: str, moment: Column) -> DataFrame:
    """The rows of a table at ``moment``, which lies before the scan; the log must reach from then to the scan's end."""
    return rolled_back(scan, first_changes(images, key, moment), key)


def rolled_back(scan: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """The scan with what its keys' first changes say in place of their rows; ``first`` is read twice."""
    same = scan.join(first.select(key), key, "left_anti").select(*scan.columns)
    return same.unionByName(first.filter(F.col("before").isNotNull()).select("before.*").select(*scan.columns))


def load_as_of(
    spark: SparkSession, scans: Mapping[str, DataFrame], logs: Mapping[str, DataFrame], keys: Mapping[str, str], moment: Column, root: str
) -> dict[str, DataFrame]:
    """Write the raw layer as of one moment; ``logs`` holds raw change envelopes (value, position) by table."""

    def changed(name: str) -> DataFrame:
        """The first changes of a table, written once: they say what goes and what comes back."""
        path = f"{root}/first_changes/{name}"
        images = parse_images(logs[name], scans[name].schema)
        first_changes(images, keys[name], moment).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    firsts = dict(zip(logs, side_by_side(*[partial(changed, name) for name in logs]))) if logs else {}
    tables = {name: rolled_back(scan, firsts[name], keys[name]) if name in firsts else scan for name, scan in scans.items()}
    load_raw(tables, root, regenerate=False)
    return read_layer(spark, root)
