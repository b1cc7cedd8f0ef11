"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are cut into blocks. With weight w, block j (from 1) of a source is released at slot
floor((j - 1) / w) and due by slot ceil(j / w); in each slot, of the released blocks the one due first runs
(earliest deadline first). Weights are whole numbers of ``slots``, so the schedule repeats after that many
slots: the driver runs the heap for one period only, and every row then computes its own slot. In any prefix
a source deviates from its target by less than one block.

A source that runs out ends a phase; the rest go on with their weights scaled up to fill every slot. No row
is dropped or repeated. The plan holds at most (sources)^2 phase entries and sources x slots slot numbers.

Defined cases: rows without a source form a source of their own; rows of a source without a target weight get
the smallest target given; repeated rows and rows without an id are mixed like any other; one source alone is
left in its order; an empty table gives an empty result. Texts play no part in the order.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut, fresh_name, numbered, placed

BLOCK_ROWS = 64
SLOTS = 1000
# Exponent on the sizes of the sources, where no targets are given: 1 keeps their shares, 0 evens them out.
TEMPERATURE = 0.5


def whole_weights(targets: dict[str, float], slots: int) -> dict[str, int]:
    """Slots per period for each source: at least one, ``slots`` in all, by largest remainder."""
    total = sum(targets.values())
    spare = slots - len(targets)
    share = {k: (v / total if total else 1 / len(targets)) * spare for k, v in targets.items()}
    weights = {k: 1 + int(v) for k, v in share.items()}
    for k in sorted(share, key=lambda k: (int(share[k]) - share[k], k))[: slots - sum(weights.values())]:
        weights[k] += 1
    return weights


def one_period(weights: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period, earliest deadline first among the released blocks."""
    slots = sum(weights.values())
    waiting = [(0, k, 1) for k in sorted(weights)]
    ready: list[tuple[int, str, int]] = []
    placed: dict[str, list[int]] = {k: [] for k in weights}
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * slots // weights[k]), k, j))
        deadline, k, j = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a block missed its deadline")
        placed[k].append(slot)
        if j < weights[k]:
            heapq.heappush(waiting, (j * slots // weights[k], k, j + 1))
    return placed


def phases(blocks: dict[str, int], targets: dict[str, float], slots: int = SLOTS) -> dict[str, list[tuple]]:
    """For each source its phases (first block, blocks, first slot, slots per period, slots of one period)."""
    plan: dict[str, list[tuple]] = {k: [] for k in blocks}
    done = dict.fromkeys(blocks, 0)
    start = 0
    while active := sorted(k for k in blocks if done[k] < blocks[k]):
        period = max(slots, 4 * len(active)) if len(active) > 1 else 1
        table = one_period(whole_weights({k: targets[k] for k in active}, period))
        last = {}
        for k in active:
            turns, rest = divmod(blocks[k] - done[k] - 1, len(table[k]))
            last[k] = turns * period + table[k][rest]
        length = min(last.values()) + 1
        for k in active:
            count = length // period * len(table[k]) + sum(s < length % period for s in table[k])
            if count:
                plan[k].append((done[k], count, start, period, table[k]))
                done[k] += count
        start += length
    return plan


def source_key(source: str) -> Column:
    """Never null, and different for a missing source and any text."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))


def scheduled(rows: DataFrame, targets: dict[str, float] | None, block_rows: int, slots: int) -> DataFrame:
    """Add block, slot and position to a stored frame with a ``_source`` column."""
    spark = rows.sparkSession
    # One row per source.
    sizes = {r["_source"]: r["n"] for r in rows.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    if targets is None:
        wanted = {k: n**TEMPERATURE for k, n in sizes.items()}
    else:
        given = {f"={k}" if k is not None else "-": float(v) for k, v in targets.items() if v > 0}
        least = min(given.values(), default=1.0)
        wanted = {k: given.get(k, least) for k in sizes}
    blocks = {k: -(-n // block_rows) for k, n in sizes.items()}
    plan = phases(blocks, wanted, slots)
    # Where a source's last block is short, all later rows move up.
    short = []
    for k, n in sizes.items():
        if n % block_rows:
            first, count, start, period, table = plan[k][-1]
            turns, rest = divmod(count - 1, len(table))
            short.append((start + turns * period + table[rest], block_rows - n % block_rows))
    kinds = (
        "_source string, _phases array<struct<first:long,count:long,start:long,period:long,table:array<int>>>, "
        "_short array<struct<slot:long,missing:long>>"
    )
    lookup = spark.createDataFrame([(k, plan[k], short) for k in plan], kinds)
    phase = F.expr("filter(_phases, p -> block >= p.first AND block < p.first + p.count)[0]")
    return (
        numbered(rows, "_source", "_index")
        .withColumn("block", F.expr(f"_index div {block_rows}"))
        .join(F.broadcast(lookup), "_source")
        .withColumn("_phase", phase)
        .withColumn("_turn", F.expr("(block - _phase.first) div size(_phase.table)"))
        .withColumn("_rest", F.expr("CAST((block - _phase.first) % size(_phase.table) AS int)"))
        .withColumn("slot", F.expr("_phase.start + _turn * _phase.period + _phase.table[_rest]"))
        .withColumn(
            "position",
            F.expr(
                f"slot * {block_rows} + _index % {block_rows} - "
                "aggregate(filter(_short, s -> s.slot < slot), 0L, (a, s) -> a + s.missing)"
            ),
        )
        .drop("_index", "_phases", "_short", "_phase", "_turn", "_rest")
    )


def mix(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    slots: int = SLOTS,
) -> DataFrame:
    """doc_id, source, block, slot and position (from 0, without gaps) of every row in the mixed order."""
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", source_key("source").alias("_source")))
    return scheduled(rows, targets, block_rows, slots).select("doc_id", "source", "block", "slot", "position")


def mixed(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    slots: int = SLOTS,
    rows_per_file: int = 16_384,
) -> DataFrame:
    """The documents with all their columns, partitioned and sorted by their mixed position."""
    place, position = (fresh_name(docs.columns, name) for name in ("_place", "_position"))
    marked = placed(docs, place)
    rows = cut(marked.select(F.col(place).alias("_place"), source_key("source").alias("_source")))
    order = cut(scheduled(rows, targets, block_rows, slots).select(F.col("_place").alias(place), F.col("position").alias(position)))
    parts = max(1, -(-order.count() // rows_per_file))
    return (
        marked.join(order, place)
        .repartitionById(parts, F.expr(f"CAST({position} div {rows_per_file} AS int)"))
        .sortWithinPartitions(position)
        .select(*docs.columns)
    )
