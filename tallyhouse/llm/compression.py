"""Product codes of vectors by exact integer k-means over Hilbert-sorted blocks.

A component x becomes the integer floor(256 * x). Vectors are cut into equal consecutive parts, each with a
codebook of its own. Tasks lay their vectors out once, in chunks: for every part the points of the chunk are sorted
along a Hilbert curve and cut into flat blocks, which store the points, their least and greatest components (the
box) and their sums. In each round the distances of a box to the entries bound the distances of its points: an
entry stays on the block's shortlist if its least distance does not exceed the smallest of the greatest ones and no
rival is nearer to all of the box, so no nearest entry and no tie is lost. A block with one entry on its list adds its stored sums; in the others an exact
integer kernel compares the points with the listed entries alone. A task sends one sum for each part, entry and
position; the driver sees those sums only, 16 x 64 entries however large the table is. Vectors are never shuffled.

Defined cases: rows whose vector is null, empty or holds null or non-finite components are dropped; rows without an
id or a label are kept, those without an id come last among the first entries; repeated rows are rows like any
other, so they may give equal entries, of which the later ones stay unused; with fewer rows than entries the
codebooks are shorter; vectors must have the length of the first kept one, which the number of parts must divide,
else a ValueError says so; integers saturate where a squared distance would not fit a long (at 64 components beyond
2**27, that is |x| of 2**19); a label's error that does not fit a long is null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import cut

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Points of a block, and components of a chunk; a stored row holds one part of a chunk.
BLOCK = 16
CHUNK_COMPONENTS = 1 << 19
# Entries each of which the others are held against in a box.
RIVALS = 2
# Bits of the Hilbert key in all.
KEY_BITS = 40


def finite(vector: Column) -> Column:
    return F.coalesce(
        (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )


def largest(components: int) -> int:
    """The greatest integer for which the squared distances of whole vectors fit a long."""
    return isqrt((1 << 62) // components) // 2


def as_integers(values: np.ndarray, components: int) -> np.ndarray:
    limit = float(largest(components))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -limit, limit).astype(np.int64)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """The place of each point (rows of integers) along a Hilbert curve through the points' box."""
    n, d = points.shape
    d = min(d, KEY_BITS)
    bits = max(1, KEY_BITS // d)
    low = points[:, :d].min(axis=0)
    span = np.maximum(points[:, :d].max(axis=0) - low, 1)
    x = (((points[:, :d] - low) / span) * ((1 << bits) - 1)).astype(np.int64).T.copy()
    # From the axes to the transposed index: undo the turns from the highest bit down, then the Gray code.
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in range(d):
            set_here = (x[axis] >> bit & 1).astype(bool)
            swap = np.where(set_here, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(set_here, below, swap)
            x[axis] ^= swap
    for axis in range(1, d):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(n, np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(d):
            key = key << 1 | (x[axis] >> bit & 1)
    return key


class Blocks:
    """The points of one part of a chunk in Hilbert order, with the box and the sums of each block."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.points, self.low, self.high, self.sums = points, low, high, sums

    @classmethod
    def of(cls, points: np.ndarray) -> Blocks:
        starts = np.arange(0, len(points), BLOCK)
        return cls(
            points,
            np.minimum.reduceat(points, starts, axis=0),
            np.maximum.reduceat(points, starts, axis=0),
            np.add.reduceat(points, starts, axis=0),
        )

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """(blocks, entries): whether the entry can be the nearest one of a point of the block."""
        below = self.low[:, None, :] - entries[None, :, :]
        above = entries[None, :, :] - self.high[:, None, :]
        least = np.maximum(np.maximum(below, above), 0)
        most = np.maximum(np.abs(below), np.abs(above))
        most = (most * most).sum(axis=2)
        listed = (least * least).sum(axis=2) <= most.min(axis=1)[:, None]
        # An entry also goes if another one, of those whose greatest distance is least, is nearer to the whole box: the
        # difference of two squared distances is linear in the point, so its maximum is at a corner.
        squares = (entries * entries).sum(axis=1)
        for rank in range(min(RIVALS, len(entries))):
            rival = np.argpartition(most, rank, axis=1)[:, rank]
            slope = 2 * (entries[None, :, :] - entries[rival][:, None, :])
            corner = np.maximum(slope * self.low[:, None, :], slope * self.high[:, None, :]).sum(axis=2)
            listed &= corner >= squares[None, :] - squares[rival][:, None]
        return listed

    def by_length(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(blocks, their shortlists) for each length of list; entries of a list in rising order."""
        listed = self.shortlists(entries)
        lengths = listed.sum(axis=1)
        for length in np.unique(lengths):
            blocks = np.flatnonzero(lengths == length)
            yield blocks, np.nonzero(listed[blocks])[1].reshape(len(blocks), length)

    def nearest(self, entries: np.ndarray, blocks: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(points, entry, squared distance) of all points of the blocks; of equally near entries the first."""
        rows = blocks[:, None] * BLOCK + np.arange(BLOCK)
        inside = rows < len(self.points)
        points = self.points[np.where(inside, rows, 0)]
        best = np.full(rows.shape, np.iinfo(np.int64).max)
        which = np.zeros(rows.shape, np.int64)
        for place in range(lists.shape[1]):
            apart = points - entries[lists[:, place]][:, None, :]
            square = np.einsum("bpd,bpd->bp", apart, apart)
            closer = square < best
            best = np.where(closer, square, best)
            which = np.where(closer, lists[:, place, None], which)
        return rows[inside], which[inside], best[inside]

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of every point and its squared distance."""
        entry = np.empty(len(self.points), np.int64)
        square = np.empty(len(self.points), np.int64)
        for blocks, lists in self.by_length(entries):
            rows, which, best = self.nearest(entries, blocks, lists)
            entry[rows], square[rows] = which, best
        return entry, square

    def add_to(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the points to the sums and counts of their nearest entries."""
        sizes = np.minimum(BLOCK, len(self.points) - np.arange(len(self.low)) * BLOCK)
        for blocks, lists in self.by_length(entries):
            if lists.shape[1] == 1:
                np.add.at(sums, lists[:, 0], self.sums[blocks])
                np.add.at(counts, lists[:, 0], sizes[blocks])
            else:
                rows, which, _ = self.nearest(entries, blocks, lists)
                counts += np.bincount(which, minlength=len(entries))
                for at in range(sums.shape[1]):
                    # Sums of one chunk are far below 2**53, so doubles hold them exactly.
                    sums[:, at] += np.bincount(which, self.points[rows, at], len(entries)).astype(np.int64)


def lay_out(rows: DataFrame, components: int) -> DataFrame:
    """(part, ids, labels, order, points, low, high, sums): each part of a chunk is one row of flat arrays.

    The ids and labels of a chunk are in the row of its first part; ``order`` gives the place in the chunk of each
    point. The parts of a chunk follow each other, also in the stored frame.
    """
    chunk = max(BLOCK, CHUNK_COMPONENTS // components)
    kind = rows.schema["label"].dataType.simpleString()
    width = components // PARTS

    def parts(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        vectors = table["vector"].combine_chunks()
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        if (np.asarray(vectors.value_lengths()) != components).any():
            raise ValueError(f"all vectors must have {components} components")
        points = as_integers(values.astype(np.float64), components).reshape(n, PARTS, width)
        made: dict[str, list] = {name: [] for name in ("order", "points", "low", "high", "sums")}
        for part in range(PARTS):
            order = np.argsort(hilbert_keys(points[:, part]), kind="stable")
            block = Blocks.of(points[order, part])
            made["order"].append(order.astype(np.int32).tobytes())
            for name in ("points", "low", "high"):
                made[name].append(getattr(block, name).astype(np.int32).tobytes())
            made["sums"].append(block.sums.tobytes())
        bounds = pa.array([0] + [n] * PARTS, pa.int32())
        listed = [pa.ListArray.from_arrays(bounds, table[c].combine_chunks()) for c in ("vec_id", "label")]
        binary = [pa.array(made[name], pa.binary()) for name in made]
        return pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS), pa.int32()), *listed, *binary], names=["part", "ids", "labels", *made]
        )

    def chunks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in stream:
            waiting.append(batch)
            held += batch.num_rows
            if held >= chunk:
                table = pa.Table.from_batches(waiting)
                for at in range(0, held - held % chunk, chunk):
                    yield parts(table.slice(at, chunk).combine_chunks())
                rest = table.slice(held - held % chunk)
                waiting, held = (rest.to_batches() if rest.num_rows else []), rest.num_rows
        if held:
            yield parts(pa.Table.from_batches(waiting).combine_chunks())

    return rows.mapInArrow(
        chunks,
        f"part int, ids array<bigint>, labels array<{kind}>, order binary, points binary, low binary, high binary, sums binary",
    )


def _blocks(batch: pa.RecordBatch, row: int, width: int) -> Blocks:
    def numbers(name: str, kind) -> np.ndarray:
        return np.frombuffer(batch[name][row].as_py(), kind).astype(np.int64).reshape(-1, width)

    return Blocks(numbers("points", np.int32), numbers("low", np.int32), numbers("high", np.int32), numbers("sums", np.int64))


def improved(layout: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, components of a part) after one round; the driver sees their sums only."""
    _, size, width = codebooks.shape

    def totals(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(codebooks.shape, np.int64)
        counts = np.zeros((PARTS, size), np.int64)
        for batch in stream:
            for row, part in enumerate(batch["part"].to_pylist()):
                _blocks(batch, row, width).add_to(codebooks[part], sums[part], counts[part])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(counts[part, entry]),
                pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    added = (
        layout.mapInArrow(totals, "part int, entry int, n long, sums array<bigint>")
        .groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    )
    after = codebooks.copy()
    for row in added.collect():  # one row for each part and used entry
        after[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return after


def coded(layout: DataFrame, codebooks: np.ndarray, label: T.DataType) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    width = codebooks.shape[2]

    def codes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = 0
        for batch in stream:
            for row, part in enumerate(batch["part"].to_pylist()):
                if part != expected:
                    raise RuntimeError("the parts of a chunk do not follow each other")
                expected = (part + 1) % PARTS
                if part == 0:
                    ids, labels = batch["ids"][row].values, batch["labels"][row].values
                    code = np.zeros((len(ids), PARTS), np.uint8)
                    error = np.zeros(len(ids), np.int64)
                order = np.frombuffer(batch["order"][row].as_py(), np.int32)
                entry, square = _blocks(batch, row, width).assign(codebooks[part])
                code[order, part] = entry
                error[order] += square
                if part == PARTS - 1:
                    text = [line.tobytes().hex() for line in code]
                    yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return layout.mapInArrow(codes, f"vec_id long, label {label.simpleString()}, code string, error long")


def compress(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept row."""
    kept = table.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).filter(finite(F.col("vector")))
    first = kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()
    components = len(first[0]["vector"]) if first else PARTS
    if components % PARTS or any(len(r["vector"]) != components for r in first):
        raise ValueError(f"vectors need one length, a multiple of {PARTS}")
    start = as_integers(np.array([r["vector"] for r in first], np.float64).reshape(len(first), components), components)
    codebooks = start.reshape(len(first), PARTS, components // PARTS).transpose(1, 0, 2).copy()
    layout = cut(lay_out(kept, components))
    for _ in range(rounds if first else 0):
        codebooks = improved(layout, codebooks)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    rows = cut(coded(layout, codebooks, kept.schema["label"].dataType))
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.expr("try_cast(sum(CAST(error AS decimal(38,0))) AS long)").alias("label_error"))
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
