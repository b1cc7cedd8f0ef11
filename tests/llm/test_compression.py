from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tallyhouse.llm import compression, queries
from tallyhouse.llm.common import prepare
from tests.llm.helpers import MIDDLE, read


def plain_codes(rows, rounds=2):
    """vec_id -> (code, error), and the digest of the codebooks, by comparing every part with every entry."""
    rows = sorted(rows, key=lambda r: r[0])
    points = np.array([np.floor(256 * np.array(v, np.float64)) for _, v in rows]).astype(np.int64).reshape(len(rows), 16, -1)
    books = points[:64].transpose(1, 0, 2).copy()

    def nearest():
        square = ((points.transpose(1, 0, 2)[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        return square.argmin(axis=2), square.min(axis=2)

    for _ in range(rounds):
        which, _ = nearest()
        for part in range(16):
            for entry in range(books.shape[1]):
                mine = points[which[part] == entry, part]
                if len(mine):
                    books[part, entry] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    which, square = nearest()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return [(r[0], bytes(which[:, i].tolist()).hex(), int(square[:, i].sum())) for i, r in enumerate(rows)], digest


def test_query_by_brute_force(spark):
    table = read(spark, MIDDLE, "embeddings")
    expected, digest = plain_codes([(r["vec_id"], r["embedding"]) for r in table.collect()])
    labels = {r["vec_id"]: r["label"] for r in table.collect()}
    by_label = defaultdict(int)
    for i, _, error in expected:
        by_label[labels[i]] += error
    got = sorted(queries.op11_hilbert_codes(spark, MIDDLE).collect(), key=lambda r: r["vec_id"])
    assert [(r["vec_id"], r["code"], r["error"]) for r in got] == expected
    assert {r["codebooks_sha256"] for r in got} == {digest}
    assert all(r["label_error"] == by_label[labels[r["vec_id"]]] for r in got)


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 3)])
def test_neighbours_on_the_curve_are_neighbours(dims, bits):
    """On a full grid whose key has exactly as many bits, each step of the curve moves by one."""
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    old = compression.KEY_BITS
    compression.KEY_BITS = bits * dims
    try:
        keys = compression.hilbert_keys(grid)
    finally:
        compression.KEY_BITS = old
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("seed", range(6))
def test_shortlists_lose_no_nearest_entry_and_no_tie(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-8, 9, (500, 3)) if seed % 2 else rng.normal(0, 100, (500, 3)).astype(np.int64)
    points = points[np.argsort(compression.hilbert_keys(points))]
    entries = np.concatenate([points[rng.integers(0, 500, 20)], rng.integers(-9, 10, (10, 3))])
    entry, square = compression.Blocks.of(points).assign(entries)
    apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (entry == apart.argmin(axis=1)).all() and (square == apart.min(axis=1)).all()
    sums, counts = np.zeros((30, 3), np.int64), np.zeros(30, np.int64)
    compression.Blocks.of(points).add_to(entries, sums, counts)
    assert (counts == np.bincount(entry, minlength=30)).all()
    assert all((sums[e] == points[entry == e].sum(axis=0)).all() for e in range(30))


def test_boxes_settle_most_entries():
    rng = np.random.default_rng(1)
    points = rng.normal(0, 30, (8192, 4)).astype(np.int64)
    points = points[np.argsort(compression.hilbert_keys(points))]
    listed = compression.Blocks.of(points).shortlists(points[rng.integers(0, 8192, 64)])
    assert listed.mean() < 0.25


def test_several_chunks_and_copies(spark, monkeypatch):
    """A third of the rows are one vector; chunks of 64 rows; several partitions."""
    monkeypatch.setattr(compression, "CHUNK_COMPONENTS", 64 * 32)
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(0, 0.3, (700, 32)), 3)
    vectors[rng.random(700) < 0.33] = vectors[5]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    frame = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted(compression.compress(frame).collect(), key=lambda r: r["vec_id"])
    expected, digest = plain_codes([r[:2] for r in rows])
    assert [(r["vec_id"], r["code"], r["error"]) for r in got] == expected and got[0]["codebooks_sha256"] == digest


def test_awkward_rows(spark):
    fine = [float(i % 5) / 4 for i in range(16)]
    rows = [
        (1, fine, None, 1, "x"),
        (1, fine, None, 1, "x"),
        (2, None, 1, 2, "x"),
        (3, [*fine[:15], None], 1, 3, "x"),
        (4, [*fine[:15], float("nan")], 1, 4, None),
        (5, [*fine[:15], float("inf")], 1, 5, "x"),
        (6, [], 1, 5, "x"),
        (None, [-1e300, *fine[1:]], 2, 5, "x"),
        (7, [-0.001] * 16, None, None, "x"),
    ]
    schema = "vec_id long, embedding array<double>, label int, error int, code string"
    got = compression.compress(prepare(spark).createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["error"]) for r in got) == [(0, 0), (1, 0), (1, 0), (7, 0)]
    # Equal entries: the later one stays unused. floor(-0.256) is -1.
    assert {r["code"] for r in got if r["vec_id"] == 1} == {"00" * 16}
    assert {r["code"] for r in got if r["vec_id"] == 7} == {"02" * 16}
    assert compression.as_integers(np.array([-0.001, -1e300]), 16).tolist() == [-1, -compression.largest(16)]
    assert compression.compress(prepare(spark).createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        compression.compress(prepare(spark).createDataFrame([(1, [1.0] * 15, 1)], "vec_id long, embedding array<double>, label int"))
