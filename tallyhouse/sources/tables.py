"""Raw tables: files, relational sources, the region seed, and the full snapshot load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schemas import GENERATED_COLUMNS, REGION_SEED, SOURCE_TABLES


def read_layer(spark: SparkSession, root: str, tables=SOURCE_TABLES) -> dict[str, DataFrame]:
    """Named tables of one layer (``raw``, ``marts``, ...), one Parquet folder each."""
    return {table: spark.read.parquet(f"{root}/{table}") for table in tables}


def read_region_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=REGION_SEED)


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], predicates: Sequence[str], cutoff: str | None = None
) -> DataFrame:
    """Scan a relational table, one task for each predicate.

    The predicates are conditions that together cover every row once. Take them from row counts of the key
    (``key_ranges``), so that a sparse or a crowded range of keys makes no small or large task. Each is a
    transaction of its own. ``cutoff`` (a timestamp literal) limits every table to rows created up to one moment,
    so that children do not outrun their parents; where the source keeps a version column, bound that instead.
    """
    source = table if cutoff is None else f"(SELECT * FROM {table} WHERE created_at <= TIMESTAMP '{cutoff}') AS snapshot"
    return spark.read.jdbc(url, source, predicates=list(predicates), properties=dict(properties))


def key_ranges(counts: DataFrame, key: str, rows_per_task: int) -> list[str]:
    """Conditions on ``key`` of about ``rows_per_task`` rows each, from (low, n): the rows per range that starts at low.

    ``counts`` is a histogram the source computes, a few thousand rows; NULL keys get a condition of their own.
    """
    bounds, size = [], 0
    for row in counts.orderBy("low").collect():
        if size and size + row["n"] > rows_per_task:
            bounds.append(row["low"])
            size = 0
        size += row["n"]
    edges = [None, *bounds, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        sides = [f"{key} >= {low}"] * (low is not None) + [f"{key} < {high}"] * (high is not None)
        parts.append(" AND ".join(sides) or f"{key} IS NOT NULL")
    return [*parts, f"{key} IS NULL"]


def recompute_generated(table: str, frame: DataFrame) -> DataFrame:
    """Leave out the columns the source generates and derive them again, in the old order."""
    generated = GENERATED_COLUMNS.get(table, {})
    loaded = frame.drop(*generated)
    return loaded.withColumns({name: F.expr(sql) for name, sql in generated.items()}).select(*frame.columns)


def load_raw(sources: Mapping[str, DataFrame], root: str, regenerate: bool = True) -> dict[str, int]:
    """Replace every raw table by a full copy of its source; rows loaded, counted while writing."""
    loaded = {}
    for table in SOURCE_TABLES:
        seen = Observation(f"load_{table}")
        frame = recompute_generated(table, sources[table]) if regenerate else sources[table]
        frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/{table}")
        loaded[table] = seen.get["rows"]
    return loaded
