"""Change-data-capture input: envelopes as JSON text, from Kafka or from any injected frame.

Every function takes a batch or a streaming frame. Each envelope is parsed once: the parsed struct leaves a
generator, through which the optimizer moves neither a filter nor a projection back over the parse.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the change format: operations that bring a new image, and the status that counts.
INSERT, UPDATE = "c", "u"
PAID = "success"


def kafka_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets_per_trigger: int,
    starting: str = "earliest",
    fail_on_data_loss: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One topic as a stream; needs Spark's Kafka package on the classpath.

    ``offsets_per_trigger`` bounds a micro-batch, the first one over a long topic included. Offsets that the broker
    has already deleted stop the stream unless ``fail_on_data_loss`` is turned off.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(offsets_per_trigger),
        **(options or {}),
    }
    return spark.readStream.format("kafka").options(**settings).load()


def parse_changes(raw: DataFrame, row: T.StructType) -> DataFrame:
    """``value`` (text or bytes) to operation and after-image; text that is no envelope gets NULLs."""
    wanted = T.StructType([T.StructField("op", T.StringType()), T.StructField("after", row)])
    return raw.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), wanted))))


def parse_images(raw: DataFrame, row: T.StructType) -> DataFrame:
    """Operation, both images, the time of the change, and its ``position`` in the log, which ``raw`` has beside ``value``."""
    kinds = {"op": T.StringType(), "before": row, "after": row, "ts_ms": T.LongType()}
    wanted = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    parsed = raw.select("position", F.inline(F.array(F.from_json(F.col("value").cast("string"), wanted))))
    return parsed.select("op", "before", "after", F.timestamp_millis("ts_ms").alias("at"), "position")


def unreadable(raw: DataFrame) -> DataFrame:
    """The texts that are no change envelope: no JSON object, or one without an operation."""
    text = F.col("value").cast("string")
    return raw.select(text.alias("value")).filter(F.get_json_object("value", "$.op").isNull())


def _event(changes: DataFrame, row: T.StructType, names: list[str], time: Column) -> DataFrame:
    """The named fields of the after-image, some with a value in place of NULL, and the event time."""
    defaults = {"amount": 0.0, "quantity": 0}
    missing = set(names) - set(row.fieldNames())
    if missing:
        raise ValueError(f"the row schema has no {sorted(missing)}")
    columns = [
        (F.coalesce(f"after.{n}", F.lit(defaults[n])) if n in defaults else F.col(f"after.{n}")).alias(n) for n in names
    ]
    return changes.select(*columns, time.alias("event_time"))


def successful_payments(changes: DataFrame, now: Column | None = None) -> DataFrame:
    """Inserts and updates that carry a successful payment, at the time it was paid.

    A payment without a readable time counts at processing time. Status is compared as written.
    """
    paid = changes.filter(F.col("op").isin(INSERT, UPDATE) & (F.col("after.payment_status") == PAID))
    row = changes.schema["after"].dataType
    at = F.coalesce(F.try_to_timestamp("after.paid_at"), F.current_timestamp() if now is None else now)
    return _event(paid, row, ["payment_id", "order_id", "amount"], at)


def created_items(changes: DataFrame) -> DataFrame:
    """Inserted order items at the time they were created; there is no default for the time."""
    row = changes.schema["after"].dataType
    created = changes.filter(F.col("op") == INSERT)
    return _event(created, row, ["product_id", "quantity", "unit_price", "line_total"], F.try_to_timestamp("after.created_at"))
