"""Sharding by longest processing time: groups that must stay together go, largest first, to the shard with
the least load, found through a heap.

The law that holds is ``bytes``: shard sizes are near equal. Equal texts form a group. A group of at least
1 / (shards x GRAIN) of all bytes is scheduled by itself; there can be at most shards x GRAIN of those. The
smaller groups are first bundled by hash into as many bundles, so the heap sees a bounded number of items at
any input size and shard sizes differ by no more than the last items placed. No group is ever split: one
that outweighs a fair shard makes its shard that much larger.

Defined cases: a null text has 8 bytes of size, CRC 0 and forms one group with other null texts; an empty
text likewise, in its own group. Repeated rows each get a slot. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut, numbered

# Items of the heap per shard, at most, of either kind.
GRAIN = 256
ROW_BYTES = 8


def longest_first(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Item -> shard: items (size, item) from the largest, each to the least loaded shard, the lowest on a tie."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        placed[item] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return placed


def shard_documents(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) for every row."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = cut(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col(text).isNull(), body).alias("_group"),
        )
    )
    groups = cut(rows.groupBy("_group").agg(F.sum("size").alias("_bytes")))
    items = shards * GRAIN
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    heavy = F.col("_bytes") * items >= F.lit(total)
    bundle = F.pmod(F.col("_group"), F.lit(items)).cast("int")
    # At most `items` rows each, whatever the input.
    large = [(r["_bytes"], ("group", r["_group"])) for r in groups.filter(heavy).collect()]
    small = [
        (r["_bytes"], ("bundle", r["_bundle"]))
        for r in groups.filter(~heavy).groupBy(bundle.alias("_bundle")).agg(F.sum("_bytes").alias("_bytes")).collect()
    ]
    placed = longest_first(large + small, shards)
    of_group = [(k, s) for (kind, k), s in placed.items() if kind == "group"]
    of_bundle = [(k, s) for (kind, k), s in placed.items() if kind == "bundle"]
    sharded = (
        rows.withColumn("_bundle", bundle)
        .join(F.broadcast(spark.createDataFrame(of_group, "_group long, _of_group int")), "_group", "left")
        .join(F.broadcast(spark.createDataFrame(of_bundle, "_bundle int, _of_bundle int")), "_bundle", "left")
        .withColumn("shard", F.coalesce("_of_group", "_of_bundle"))
    )
    return numbered(sharded, "shard", "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
