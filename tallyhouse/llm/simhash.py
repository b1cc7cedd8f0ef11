"""SimHash near-dedup by anchor-point covering.

A fingerprint of 64 bits is cut into three parts. Fingerprints at 4 or fewer differing bits differ by at most
one bit in one of the parts (4 // 3 = 1). In each part the anchors are the words of the binary Golay code of
length 23: every point lies within 3 bits of exactly one of them, its home. A fingerprint is replicated to
every anchor within 3 + 1 bits of the part, so two fingerprints that differ by one bit there meet at the home
of either. At an anchor, those at home are compared with all replicas, on all 64 bits.

With more points than fill one cell of each of the 4,096 anchors, a finer code is taken: fingerprints at 4 or fewer
differing bits agree in one of five blocks, and the other bits, in three parts, again differ by at most one in one of
them. The code is the block's bits as they are and a Golay word of the part, about 2^25 anchors for each of the 15
choices, so the points of an anchor stay few. Both codes find the same links.

Equal fingerprints are taken together first, so a group of copies of any size is one point. Anchors of many
points are split into cells: each takes one share of the points at home and one share of all points, and every two
shares meet in one cell, so no task holds an anchor whole. Within a cell the links found are reduced to a spanning
forest, which keeps every connection; the forests are joined by ``components``, whose steps run as Spark joins.

Defined cases: null and empty texts and texts without words have fingerprint zero and link like any other;
texts of fewer words than a shingle are one shingle; every row of the input is returned, repeated ones too; a
component is named by the smallest doc_id in it, null only if all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import components, cut, fresh_name, map_texts, placed

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
BITS, PARTS = 64, 3
# The bits a part lacks to the length of the code are zero.
CODE_LENGTH, CODE_RADIUS = 23, 3
# Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a generator of the binary Golay code.
GENERATOR = 0b101011100011
# Points at home, and points they are compared with, of one cell of an anchor.
CELL_POINTS, CELL_REPLICAS = 2048, 16_384
# Distinct fingerprints up to which the anchors are those of a part alone.
COARSE_POINTS = CELL_POINTS << 12
# Pairs compared at once.
BLOCK_PAIRS = 1 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number: a bit is set if it is in over half the hashes."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist())],
        np.uint64,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


@lru_cache(maxsize=1)
def code() -> tuple[np.ndarray, np.ndarray]:
    """The home anchor of every point of the code's space, and the anchors' words."""
    words = np.zeros(1 << 12, np.int64)
    for bit in range(12):
        has = (np.arange(1 << 12) >> bit & 1).astype(bool)
        words[has] ^= GENERATOR << bit
    home = np.full(1 << CODE_LENGTH, -1, np.int16)
    flips = {0}
    for _ in range(CODE_RADIUS):
        flips |= {flip ^ (1 << bit) for flip in flips for bit in range(CODE_LENGTH)}
    for flip in flips:
        home[words ^ flip] = np.arange(1 << 12)
    return home, words


def split(bits: int, pieces: int) -> list[tuple[int, int]]:
    """Pieces of a number as (shift, bits), as even as can be."""
    bounds = [-(-bits * k // pieces) for k in range(pieces + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def covers(fine: bool, most_bits: int) -> list[tuple[int, int, int, int]]:
    """(shift, bits) of a block, and of a part of the other bits, for every choice of both; a coarse code has no block."""
    blocks = split(BITS, most_bits + 1) if fine else [(0, 0)]
    return [(*block, *part) for block in blocks for part in split(BITS - block[1], PARTS)]


def anchors(points: np.ndarray, bits: int = CODE_LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, anchors, at home): the home of each point of so many bits, then every other anchor within radius + 1 that
    can be the home of such a point one bit away.

    Of the full length, an anchor is that near exactly if it is the home of the point or of a point one bit away."""
    home, _ = code()
    own = home[points]
    yield np.arange(len(points)), own, True
    near = np.stack([home[points ^ (1 << bit)] for bit in range(bits)], axis=1)
    near.sort(axis=1)
    new = near != own[:, None]
    new[:, 1:] &= near[:, 1:] != near[:, :-1]
    rows, columns = np.nonzero(new)
    yield rows, near[rows, columns], False


def replicate(
    stream: Iterator[pa.RecordBatch], chosen: list[tuple[int, int, int, int]]
) -> Iterator[pa.RecordBatch]:
    """(fp) to (anchor, fp, home): one row at home and one for each replica, in each cover."""
    for batch in stream:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for number, (shift, bits, part_shift, part_bits) in enumerate(chosen):
            block, low = piece(points, shift, bits), points & np.uint64((1 << shift) - 1)
            others = low | (points >> np.uint64(shift + bits) << np.uint64(shift))
            name = (np.int64(number) << bits | block.astype(np.int64)) << 12
            for rows, found, at_home in anchors(piece(others, part_shift, part_bits).astype(np.int64), part_bits):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name[rows] + found, pa.int64()),
                        pa.array(points[rows].view(np.int64), pa.int64()),
                        pa.array(np.full(len(rows), at_home)),
                    ],
                    names=["anchor", "fp", "home"],
                )


def piece(points: np.ndarray, shift: int, bits: int) -> np.ndarray:
    return points >> np.uint64(shift) & np.uint64((1 << bits) - 1)


def forest(points: np.ndarray, at_home: np.ndarray, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between points at home and all points of a cell."""
    tree = np.arange(len(points))
    left, right = [], []
    homes = np.flatnonzero(at_home)
    step = max(1, BLOCK_PAIRS // max(1, len(points)))
    for at in range(0, len(homes), step):
        rows = homes[at : at + step]
        near = np.bitwise_count(points[rows, None] ^ points[None, :]) <= most_bits
        for k in np.flatnonzero(near.sum(axis=1) > 1).tolist():
            i, linked = rows[k], np.flatnonzero(near[k])
            trees, first = np.unique(tree[linked], return_index=True)
            if len(trees) > 1:
                new = linked[first[trees != tree[i]]]
                left += [i] * len(new)
                right += new.tolist()
                tree[np.isin(tree, trees)] = trees[0]
    return points[left], points[right]


def links(fingerprints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all that are near enough."""
    if most_bits // PARTS != 1:
        raise ValueError("the anchors cover 3 to 5 differing bits")
    fine = fingerprints.count() > COARSE_POINTS
    chosen = covers(fine, most_bits)
    replicas = fingerprints.select("fp").mapInArrow(
        lambda stream: replicate(stream, chosen), "anchor long, fp long, home boolean"
    )
    counts = replicas.groupBy("anchor").agg(
        F.ceil(F.count_if("home") / CELL_POINTS).cast("int").alias("_homes"),
        F.ceil(F.count(F.lit(1)) / CELL_REPLICAS).cast("int").alias("_shares"),
    )
    # A coarse code has 3 x 4096 anchors.
    counts = counts.filter("_homes > 0") if fine else F.broadcast(counts.filter("_homes > 0"))
    share = "CAST(pmod(xxhash64(fp, 1), _shares) AS int)"
    own = "CAST(pmod(xxhash64(fp), _homes) AS int) * _shares"
    mine = f"IF(home, sequence({own}, {own} + _shares - 1), CAST(array() AS array<int>))"
    cells = (
        replicas.join(counts, "anchor")
        .withColumn(
            "cell",
            F.explode(
                F.expr(
                    "CASE WHEN _homes = 1 AND _shares = 1 THEN array(0) "
                    f"ELSE array_union({mine}, sequence({share}, {share} + (_homes - 1) * _shares, _shares)) END"
                )
            ),
        )
        .select("anchor", "cell", "fp", F.expr(f"home AND cell >= {own} AND cell < {own} + _shares").alias("home"))
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        points = rows["fp"].to_numpy().view(np.uint64)
        a, b = forest(points, rows["home"].to_numpy(), most_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return cells.groupBy("anchor", "cell").applyInPandas(compare, "a long, b long")


def fingerprints(
    docs: DataFrame, shingle_words: int, doc_id: str = "doc_id", text: str = "text", place: str | None = None
) -> DataFrame:
    """(doc_id, fp) of every row, and its place if that column is named."""
    along = [F.col(place).alias("place")] if place else []
    return map_texts(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), *along, F.col(text).alias("text")),
        "text",
        "doc_id long, place long, fp long" if place else "doc_id long, fp long",
        {"fp": pa.int64()},
        lambda texts: [[signed(fingerprint(t, shingle_words)) for t in texts]],
    )


def labelled(prints: DataFrame, most_bits: int) -> DataFrame:
    """(fp, component, component_id) of every distinct fingerprint of a stored frame (doc_id, fp)."""
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(classes.select(F.col("fp").alias("node")), links(classes, most_bits))
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return cut(named.join(smallest, "component").select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    prints = cut(fingerprints(docs, shingle_words))
    names = labelled(prints, most_bits).select("fp", "component_id")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of each component, the one of the smallest doc_id, with all its columns."""
    place = fresh_name(docs.columns, "_place")
    marked = placed(docs, place)
    prints = cut(fingerprints(marked, shingle_words, place=place))
    names = labelled(prints, most_bits).select("fp", "component")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place"))["place"]
    kept = cut(prints.join(names, "fp").groupBy("component").agg(first.alias(place)).select(place))
    return marked.join(kept, place, "left_semi").select(*docs.columns)
