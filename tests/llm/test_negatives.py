from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tallyhouse.llm import negatives, queries
from tallyhouse.llm.common import prepare
from tests.llm.helpers import MIDDLE, read


def plain(rows, every=100):
    """Hard negatives of rows (id, label, vector): every anchor against every row."""
    ints = [(i, label, [int(x) for x in np.floor(256 * np.array(v, np.float64))]) for i, label, v in rows]
    out = []
    for place, (anchor, label, v) in enumerate(ints):
        if anchor % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), i, other == label)
            for at, (i, other, w) in enumerate(ints)
            if at != place and len(w) == len(v)
        )
        for s, positive, _ in [x for x in scored if x[2]][:5]:
            inside = [(t, i) for t, i, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(inside[:5], 1)]
    return sorted(out)


def test_query_by_brute_force(spark):
    rows = []
    for r in read(spark, MIDDLE, "embeddings").collect():
        rows.append((r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]))
    found = sorted(map(tuple, queries.op12_hard_negatives(spark, MIDDLE).collect()))
    assert found == plain(rows) and found


@pytest.mark.parametrize("seed", range(2))
def test_tiles_ties_and_copies(spark, seed):
    """Small integers give many ties; a third of the rows are one vector, and ids repeat; several groups and blocks."""
    rng = random.Random(seed)
    hot = [rng.randint(-2, 2) / 4 for _ in range(4)]
    rows = []
    for _ in range(600):
        vector = hot if rng.random() < 0.33 else [rng.randint(-2, 2) / 4 for _ in range(rng.choice([4, 4, 5]))]
        rows.append((rng.randrange(400), rng.randrange(3), vector))
    frame = prepare(spark).createDataFrame(rows, "vec_id long, label int, vector array<double>")
    found = negatives.mine(frame, every=10, group_rows=97, block_anchors=16).collect()
    assert sorted(map(tuple, found)) == plain(rows, 10)


def test_pairs_are_reduced_while_a_tile_is_read(spark, monkeypatch):
    monkeypatch.setattr(negatives, "HELD_PAIRS", 10)
    monkeypatch.setattr(negatives, "MATRIX_COMPONENTS", 32)
    rng = random.Random(5)
    rows = [(i, i % 4, [rng.randint(-3, 3) / 4 for _ in range(4)]) for i in range(300)]
    frame = prepare(spark).createDataFrame(rows, "vec_id long, label int, vector array<double>")
    assert sorted(map(tuple, negatives.mine(frame, every=20).collect())) == plain(rows, 20)


def test_keys_sort_by_anchor_then_descending_score():
    rng = random.Random(2)
    edge = [-(1 << 62), -1, 0, 1, (1 << 62) - 1]
    rows = [(rng.choice(edge), rng.choice(edge), rng.random() < 0.5, rng.choice(edge)) for _ in range(300)]
    keys = negatives.sort_key(*[np.array(c) for c in zip(*rows)])
    by_key = [r for _, r in sorted(zip(keys, rows), key=lambda x: x[0])]
    assert by_key == sorted(rows, key=lambda r: (r[0], -r[1], not r[2], r[3]))


def test_windows_are_streamed():
    """A negative with the score of a positive comes into its window although its id is smaller."""
    rows = [(1, 10, True, 7), (1, 10, False, 3), (1, 9, True, 8), (1, 8, False, 4), (1, 7, False, 5), (2, 8, False, 6)]
    anchor, score, positive, ids = map(np.array, zip(*rows))
    found = list(negatives.streamed(iter(sorted(negatives.sort_key(anchor, score, positive, ids)))))
    assert found == [(1, 7, 1, 3, 10, 10), (1, 7, 2, 4, 10, 8), (1, 8, 1, 4, 9, 8)]
    by_anchor = defaultdict(list)
    for row in found:
        by_anchor[row[0]].append(row)
    assert set(by_anchor) == {1}


def test_products_beyond_doubles_are_exact():
    a = np.array([[1 << 30, 1], [3, -(1 << 30)]])
    assert negatives.scores(a, a).tolist() == [[(1 << 60) + 1, (3 << 30) - (1 << 30)], [(3 << 30) - (1 << 30), 9 + (1 << 60)]]


def test_awkward_rows(spark):
    rows = [
        (100, [1.0, 0.5], 1, 1, "a"),
        (None, [1.0, 0.5], 1, 1, "a"),
        (1, None, 1, 1, "a"),
        (2, [1.0, None], 1, 1, "a"),
        (3, [float("nan"), 0.5], 1, 1, "a"),
        (4, [], 1, 1, None),
        (5, [1.0, 0.5], None, 1, "a"),
        (6, [1.0, 0.25], 1, None, "a"),
        (8, [0.9, 0.25], 2, None, "a"),
        (9, [0.9, 0.25, 0.1], 2, None, "a"),
        (8, [0.9, 0.25], 2, None, "a"),
        (200, [-1e300, 0.0], 2, None, "a"),
    ]
    schema = "vec_id long, embedding array<double>, label int, rank int, anchor string"
    found = sorted(map(tuple, negatives.hard_negatives(prepare(spark).createDataFrame(rows, schema)).collect()))
    usable = [(i, x, v) for i, v, x, *_ in rows if i is not None and x is not None and v and all(c is not None and c == c for c in v)]
    limited = [(i, x, [max(c, -1000.0) for c in v]) for i, x, v in usable]
    assert [f for f in found if f[0] == 100] == [p for p in plain(limited) if p[0] == 100] != []
    assert negatives.hard_negatives(prepare(spark).createDataFrame([], schema)).count() == 0
