"""Helpers that several of the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

# Rows per Arrow batch: texts may be long, so a batch of them must stay small.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_BATCH = "512"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WHITE = "[\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set(BATCH_ROWS, TEXT_BATCH)
    # Python workers import this package from where the driver has it, unless it was shipped to them.
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared checkpoint folder, so that a lost executor costs nothing
    that was done before. Only a local session without the setting falls back to a folder of its own."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or shared_folder(frame.sparkSession, "checkpoints"))
    return frame.checkpoint(eager=True)


def map_texts(
    frame: DataFrame,
    text: str,
    schema: str,
    columns: dict[str, pa.DataType],
    function: Callable[[list[bytes | None]], list],
) -> DataFrame:
    """Columns computed from each text: ``function`` turns a list of UTF-8 texts into one list per new column.

    The other columns of the frame go along; texts do not come back. ``schema`` describes the whole result.
    """
    names = [c for c in frame.columns if c != text]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            made = function(texts)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            new = [pa.array(values, type=kind) for values, kind in zip(made, columns.values())]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*names, *columns])

    return frame.mapInArrow(batches, schema)


# Nodes of a plan that give each row the same place in every read.
KEEPS_PLACES = {"Project", "Filter", "Relation", "LocalRelation"}


def fresh_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def placed(docs: DataFrame, name: str) -> DataFrame:
    """The frame with a number for each row that is the same however often the frame is read.

    Rows read from files, with nothing but projections and filters in between, keep their place; all others are stored."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    nodes = {line.lstrip(" :+-").split(" ")[0] for line in plan.toString().splitlines() if line.strip()}
    marked = docs.withColumn(name, F.monotonically_increasing_id())
    return marked if nodes <= KEEPS_PLACES and plan.deterministic() else cut(marked)


def numbered(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in the order the rows are stored.

    Expects a frame that ``cut`` has stored, whose partitions are fixed. Rows are numbered inside each
    partition and moved up by the number of rows the partitions before hold, so a key with most of the
    rows is still worked on in parallel.
    """
    place = frame.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_row", 33)
    )
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        place.groupBy(key, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(key, "_part").orderBy("_row")
    return (
        place.withColumn("_in", F.row_number().over(inside) - 1)
        .join(offsets, [key, "_part"])
        .withColumn(name, F.col("_before") + F.col("_in"))
        .drop("_row", "_part", "_in", "_before")
    )


def crc_of_id(name: str) -> Column:
    """CRC-32 of an id written as text; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b) of long node ids.

    Alternates large-star and small-star steps, which keep one edge per node and round and halve paths, so
    a hub costs no more than its own edges. Each round is stored; the loop ends when no edge changes.
    """
    spark = edges.sparkSession

    def both_ways(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )

    def summary(e: DataFrame):
        row = e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        return row[0], row[1]

    current = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = summary(current)
    for _ in range(most_rounds):
        if not state[0]:
            break
        # Large star: every larger neighbour of u is tied to u's smallest neighbour.
        pairs = both_ways(current)
        low = pairs.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = (
            pairs.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("w").alias("b")).distinct()
        )
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("w"))
        tied = F.array(F.struct(F.col("b").alias("u"), "w"), F.struct(F.col("a").alias("u"), "w"))
        small = large.join(low, "a").select(F.inline(tied)).toDF("a", "b").filter("a <> b").distinct()
        current = cut(small)
        now = summary(current)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    label = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return nodes.select("node").distinct().join(label, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
