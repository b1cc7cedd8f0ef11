"""Hard negatives by a secondary sort.

Anchors are a stated share of the rows; each is scored against all rows. Rows are dealt to groups of a bounded
size and anchors to blocks of a bounded size, and a tile is one block with one group: the block's anchors are held,
the group's rows stream past in small matrices. So a task holds one block, whatever the sizes of the table, of a
label or of a group of copies.

A first pass over the tiles finds the positives, of which a tile sends on only its own first ones for each anchor.
They open one window of scores each; in the second pass a tile sends on its first negatives in each window. The pairs
are packed into keys (anchor, descending score, positives before negatives, id) whose bytes sort in that order,
dealt by anchor and sorted within the partitions, by ``repartition`` and ``sortWithinPartitions``, the frame's form of
``repartitionAndSortWithinPartitions``. A streaming iterator then reads each partition once: a positive opens its
window, negatives go to the open windows with room, and a window closes when the scores fall below it. No
anchor's pairs are gathered.

What a tile leaves out cannot be among an anchor's first positives or the first negatives of a window, as the tile
itself holds enough better ones. Scores are exact integers.

Defined cases: rows without an id or a label, and those whose vector is null, empty or holds null or non-finite
components take no part; only vectors of the same length are compared; repeated rows are rows of their own, each an
anchor, a positive or a negative; integers saturate where a hundred times an inner product would not fit a long (at
64 components beyond 2**25, that is |x| of 2**17); an anchor without positives, or a window without negatives, gives
no row; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut
from tallyhouse.llm.compression import SCALE, finite

POSITIVES = 5
NEGATIVES = 5
# A window holds the scores from this many hundredths of the positive's score up to that score.
LEAST_PERCENT = 80
GROUP_ROWS = 4096
BLOCK_ANCHORS = 4096
# Components of one stored matrix, and pairs a task holds back before it reduces them.
MATRIX_COMPONENTS = 1 << 15
HELD_PAIRS = 1 << 20
MOST_PARTITIONS = 20_000

MATRIX = "part int, dim int, ids binary, labels binary, places binary, vectors binary, opened binary"
COLUMNS = [column.split()[0] for column in MATRIX.split(", ")]


def as_integers(values: np.ndarray, dim: int) -> np.ndarray:
    """floor(256 * x), saturated so that a hundred times an inner product fits a long."""
    limit = float(min(isqrt(((1 << 63) - 1) // (100 * dim)), (1 << 31) - 1))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -limit, limit).astype(np.int64)


class Rows:
    """Ids, labels, places, integer vectors and the scores of the opened windows (their number, then the scores) of some rows."""

    def __init__(self, ids, labels, places, vectors, opened):
        self.ids, self.labels, self.places, self.vectors, self.opened = ids, labels, places, vectors, opened

    @classmethod
    def of(cls, batch: pa.RecordBatch, row: int) -> Rows:
        def read(name: str, kind=np.int64) -> np.ndarray:
            return np.frombuffer(batch[name][row].as_py(), kind)

        dim = batch["dim"][row].as_py()
        return cls(read("ids"), read("labels"), read("places"), read("vectors", np.int32).reshape(-1, dim), read("opened").reshape(-1, POSITIVES + 1))

    def batch(self, part: int) -> pa.RecordBatch:
        flat = [self.ids, self.labels, self.places, self.vectors.astype(np.int32), self.opened]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([self.vectors.shape[1]], pa.int32()),
                *[pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in flat],
            ],
            names=COLUMNS,
        )

    def some(self, which: np.ndarray) -> Rows:
        return Rows(*[a[which] for a in (self.ids, self.labels, self.places, self.vectors, self.opened)])

    @staticmethod
    def together(rows: list[Rows]) -> Rows:
        return Rows(*[np.concatenate([getattr(r, n) for r in rows]) for n in ("ids", "labels", "places", "vectors", "opened")])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; by doubles where these hold every sum."""
    most = int(np.abs(a, dtype=np.int64).max(initial=0)) * int(np.abs(b, dtype=np.int64).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _matrices(rows: list[Rows], part: int) -> Iterator[pa.RecordBatch]:
    whole = Rows.together(rows)
    step = max(1, MATRIX_COMPONENTS // whole.vectors.shape[1])
    for at in range(0, len(whole.ids), step):
        yield whole.some(np.arange(at, min(at + step, len(whole.ids)))).batch(part)


def packed(rows: DataFrame, parts: int) -> DataFrame:
    """(vec_id, label, vector) dealt to ``parts`` groups, as matrices; a row's place is its group and number there."""

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, waiting = 0, {}
        for batch in stream:
            places = (part << 32) + seen + np.arange(batch.num_rows)
            seen += batch.num_rows
            lengths = np.asarray(batch["vector"].value_lengths())
            for dim in np.unique(lengths).tolist():
                which = pa.array(np.flatnonzero(lengths == dim))
                mine = batch.take(which)
                values = mine["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                held = waiting.setdefault(dim, [])
                held.append(
                    Rows(
                        mine["vec_id"].to_numpy(zero_copy_only=False).astype(np.int64),
                        mine["label"].to_numpy(zero_copy_only=False).astype(np.int64),
                        places[lengths == dim],
                        as_integers(values, dim).reshape(-1, dim),
                        np.zeros((mine.num_rows, POSITIVES + 1), np.int64),
                    )
                )
                if sum(r.vectors.size for r in held) >= MATRIX_COMPONENTS:
                    yield from _matrices(waiting.pop(dim), part)
        for held in waiting.values():
            yield from _matrices(held, part)

    return rows.select("vec_id", "label", "vector").repartition(parts).mapInArrow(pack, MATRIX)


def anchors_of(matrices: DataFrame, every: int) -> DataFrame:
    """The anchors among the packed rows, one row each, with its place and id."""

    def pick(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in range(batch.num_rows):
                rows = Rows.of(batch, row)
                for i in np.flatnonzero(rows.ids % every == 0):
                    one = rows.some(np.array([i])).batch(0)
                    named = [pa.array([rows.places[i]]), pa.array([rows.ids[i]])]
                    yield pa.RecordBatch.from_arrays([*one.columns, *named], names=[*one.schema.names, "place", "anchor_id"])

    return matrices.mapInArrow(pick, f"{MATRIX}, place long, anchor_id long")


def in_blocks(anchors: DataFrame, blocks: int) -> DataFrame:
    """Anchors, one row each, dealt to blocks and packed into matrices again."""

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: dict[int, list[Rows]] = {}
        for batch in stream:
            for row in range(batch.num_rows):
                rows = Rows.of(batch, row)
                held = waiting.setdefault(rows.vectors.shape[1], [])
                held.append(rows)
                if len(held) * rows.vectors.shape[1] >= MATRIX_COMPONENTS:
                    yield from _matrices(waiting.pop(rows.vectors.shape[1]), part)
        for held in waiting.values():
            yield from _matrices(held, part)

    return anchors.select(*COLUMNS).repartition(blocks).mapInArrow(pack, MATRIX)


def first_positives(found: tuple, anchors: Rows) -> tuple:
    """Of pairs (anchor, score, id) the first positives of each anchor."""
    anchor, score, ids = found
    order = np.lexsort((ids, -score, anchor))
    anchor = anchor[order]
    rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    keep = order[rank < POSITIVES]
    return tuple(a[keep] for a in found)


def first_negatives(found: tuple, anchors: Rows) -> tuple:
    """Of pairs (anchor, score, id) those among the first negatives of one of the anchor's windows."""
    anchor, score, ids = found
    order = np.lexsort((ids, -score, anchor))
    anchor, score, ids = anchor[order], score[order], ids[order]
    keep = np.zeros(len(anchor), bool)
    start = np.searchsorted(anchor, anchor)
    for window in range(POSITIVES):
        best = anchors.opened[anchor, 1 + window]
        inside = (window < anchors.opened[anchor, 0]) & (LEAST_PERCENT * best <= 100 * score) & (score <= best)
        before = np.concatenate([[0], np.cumsum(inside)])
        keep |= inside & (before[:-1] - before[start] < NEGATIVES)
    return anchor[keep], score[keep], ids[keep]


def same_label(anchors: Rows, rows: Rows, score: np.ndarray) -> np.ndarray:
    """Which pairs can give positives: no pair below the anchor's fifth best here."""
    fits = (anchors.labels[:, None] == rows.labels[None, :]) & (anchors.places[:, None] != rows.places[None, :])
    if score.shape[1] > POSITIVES:
        ranked = np.where(fits, score, np.iinfo(np.int64).min)
        least = np.partition(ranked, -POSITIVES, axis=1)[:, -POSITIVES]
        fits &= score >= least[:, None]
    return fits


def other_label(anchors: Rows, rows: Rows, score: np.ndarray) -> np.ndarray:
    """Which pairs lie in one of the anchor's windows."""
    inside = np.zeros(score.shape, bool)
    for window in range(POSITIVES):
        best = anchors.opened[:, 1 + window, None]
        inside |= (window < anchors.opened[:, :1]) & (LEAST_PERCENT * best <= 100 * score) & (score <= best)
    return inside & (anchors.labels[:, None] != rows.labels[None, :])


def scored(blocks: DataFrame, groups: DataFrame, counts: tuple[int, int], wanted: Callable, reduced: Callable) -> DataFrame:
    """(anchor place, score, id) of the pairs that every tile keeps."""
    n_blocks, n_groups = counts
    tiles = n_blocks * n_groups
    held = blocks.withColumn("_tile", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).select(
        (F.col("_tile") * n_blocks + F.col("part")).cast("long").alias("tile"), F.lit(0).alias("kind"), *blocks.columns
    )
    passing = groups.withColumn("_tile", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).select(
        (F.col("part") * n_blocks + F.col("_tile")).cast("long").alias("tile"), F.lit(1).alias("kind"), *groups.columns
    )
    parts = min(tiles, MOST_PARTITIONS)
    dealt = (
        held.unionByName(passing)
        .repartitionById(parts, F.expr(f"CAST(tile % {parts} AS int)"))
        .sortWithinPartitions("tile", "kind")
    )

    def pairs(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, waiting, anchors = -1, {}, {}
        found: dict[int, list[tuple]] = {}

        def reduce(dim: int) -> None:
            parts = [np.concatenate(columns) for columns in zip(*found[dim])]
            found[dim] = [reduced(tuple(parts), anchors[dim])]

        def finish() -> Iterator[pa.RecordBatch]:
            for dim in found:
                reduce(dim)
                anchor, score, ids = found[dim][0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[dim].places[anchor]), pa.array(score), pa.array(ids)], names=["anchor", "score", "vec_id"]
                )

        for batch in stream:
            for row in range(batch.num_rows):
                if batch["tile"][row].as_py() != tile:
                    yield from finish()
                    tile, waiting, anchors, found = batch["tile"][row].as_py(), {}, {}, {}
                rows = Rows.of(batch, row)
                dim = rows.vectors.shape[1]
                if batch["kind"][row].as_py() == 0:
                    waiting.setdefault(dim, []).append(rows)
                    continue
                if dim not in waiting:
                    continue
                if dim not in anchors:
                    anchors[dim] = Rows.together(waiting[dim])
                some = anchors[dim]
                score = scores(some.vectors, rows.vectors)
                a, b = np.nonzero(wanted(some, rows, score))
                found.setdefault(dim, []).append((a, score[a, b], rows.ids[b]))
                if sum(len(f[0]) for f in found[dim]) > HELD_PAIRS:
                    reduce(dim)
        yield from finish()

    return dealt.mapInArrow(pairs, "anchor long, score long, vec_id long")


def with_windows(anchors: DataFrame, positives: DataFrame) -> DataFrame:
    """The anchors that have positives, with the number and the scores of these."""
    ranked = positives.groupBy("anchor").agg(F.sort_array(F.collect_list("score"), asc=False).alias("best"))

    def add(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row, best in enumerate(batch["best"].to_pylist()):
                rows = Rows.of(batch, row)
                rows.opened = np.array([[len(best), *best, *[0] * (POSITIVES - len(best))]], np.int64)
                yield rows.batch(0)

    return anchors.join(ranked, F.col("place") == F.col("anchor")).select(*COLUMNS, "best").mapInArrow(add, MATRIX)


KEY = struct.Struct(">QQBQ")
SIGN = 1 << 63


def sort_key(anchor: np.ndarray, score: np.ndarray, positive: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """Bytes in the order of anchor, descending score, positives before negatives, id."""
    columns = (anchor.tolist(), score.tolist(), positive.tolist(), ids.tolist())
    return [KEY.pack(a + SIGN, SIGN - 1 - s, not p, i + SIGN) for a, s, p, i in zip(*columns)]


def streamed(keys: Iterator[bytes]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor place, positive id, rank, negative id, both scores) from packed keys in order; holds the open windows only."""
    current, windows = None, []
    for key in keys:
        anchor, turned, negative, shifted = KEY.unpack(key)
        score, vec_id = SIGN - 1 - turned, shifted - SIGN
        if anchor != current:
            current, windows = anchor, []
        if not negative:
            windows.append([vec_id, score, 0])
            continue
        windows = [w for w in windows if w[2] < NEGATIVES and LEAST_PERCENT * w[1] <= 100 * score]
        for window in windows:
            if 100 * score <= 100 * window[1]:
                window[2] += 1
                yield anchor - SIGN, window[0], window[2], vec_id, window[1], score


def mined(pairs: DataFrame, parts: int) -> DataFrame:
    """The hard negatives from pairs (anchor, score, positive, vec_id)."""

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            columns = [batch[name].to_numpy(zero_copy_only=False) for name in ("anchor", "score", "positive", "vec_id")]
            yield pa.RecordBatch.from_arrays([batch["anchor"], pa.array(sort_key(*columns), pa.binary())], names=["anchor", "key"])

    def windows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for row in streamed(key for b in stream for key in b["key"].to_pylist()):
            rows.append(row)
            if len(rows) == 4096:
                yield batch()
                rows = []
        if rows:
            yield batch()

    keyed = pairs.mapInArrow(pack, "anchor long, key binary").repartition(parts, "anchor").sortWithinPartitions("key")
    return keyed.select("key").mapInArrow(
        windows, "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )


def mine(rows: DataFrame, every: int = 100, group_rows: int = GROUP_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """The hard negatives of the rows (vec_id, label, vector) whose id is divisible by ``every``."""
    usable = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector")))
    n_groups = max(1, -(-usable.count() // group_rows))
    groups = cut(packed(usable, n_groups))
    anchors = cut(anchors_of(groups, every))
    n_blocks = max(1, -(-anchors.count() // block_anchors))
    counts = (n_blocks, n_groups)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    near = scored(in_blocks(anchors, n_blocks), groups, counts, same_label, first_positives)
    positives = cut(near.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= POSITIVES).drop("_rank"))
    opened = cut(with_windows(anchors, positives))
    negatives = scored(in_blocks(opened, n_blocks), groups, counts, other_label, first_negatives)
    pairs = positives.withColumn("positive", F.lit(True)).unionByName(negatives.withColumn("positive", F.lit(False)))
    names = anchors.select(F.col("place").alias("anchor"), "anchor_id")
    parts = max(1, min(MOST_PARTITIONS, n_blocks * n_groups))
    return mined(pairs, parts).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def hard_negatives(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The hard negatives of a table, after the labels of every seventh id have been moved on by one."""
    moved = F.when(F.col(vec_id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    return mine(table.select(F.col(vec_id).alias("vec_id"), moved.alias("label"), F.col(vector).alias("vector")))
