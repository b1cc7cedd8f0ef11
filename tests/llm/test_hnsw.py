from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq

from tallyhouse.llm import hnsw, queries
from tallyhouse.llm.common import prepare
from tests.llm.helpers import MIDDLE


def plain(rows, every=50, k=5):
    """Nearest neighbours by comparing with every row."""
    def cosine(a, b):
        return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))

    out = {}
    for i, q in rows:
        if i % every == 0:
            found = sorted((-cosine(q, v), j) for j, v in rows if j != i)[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark):
    table = pq.read_table(f"{MIDDLE}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], np.array(r["embedding"], np.float64)) for r in table]
    expected, found = plain(rows), by_query(queries.op1_hnsw(spark, MIDDLE).collect())
    assert set(found) == set(expected)
    hits = [j in dict(found[i]) for i in expected for j, _ in expected[i]]
    assert np.mean(hits) >= 0.9
    vectors = dict(rows)
    for i, near in found.items():
        assert len(near) == 5 and i not in dict(near)
        for j, s in near:
            a, b = vectors[i], vectors[j]
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_graph_recall_on_many_shards(spark):
    prepare(spark)
    rng = np.random.default_rng(1)
    data = rng.normal(size=(3000, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    found = by_query(hnsw.nearest_neighbours(frame, shard_nodes=500).collect())
    expected = plain(list(enumerate(data)))
    hits = [j in dict(found[i]) for i in expected for j, _ in expected[i]]
    assert np.mean(hits) >= 0.95


def test_flat_arrays_give_the_same_graph():
    unit = hnsw.unit_rows(np.random.default_rng(2).normal(size=(400, 8)))
    graph = hnsw.Graph(unit, 4).build(width=32)
    again = hnsw.Graph.of(unit, *graph.flat(), m=4)
    assert len(graph.upper) >= 2 and again.entry == graph.entry
    for q in unit[:20]:
        assert graph.search(q, 20) == again.search(q, 20)


def test_copies_and_ties(spark):
    """A vector that most rows share: its smallest ids are found, however many there are."""
    prepare(spark)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(i, rng.normal(size=3).tolist()) for i in range(300, 500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_query(hnsw.nearest_neighbours(frame, shard_nodes=64).collect())
    assert [j for j, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [j for j, _ in found[150]] == [0, 1, 2, 3, 4]
    expected = plain([(i, np.array(v)) for i, v in rows])
    assert np.mean([[j for j, _ in found[i]] == [j for j, _ in expected[i]] for i in expected]) >= 0.9


def test_awkward_rows(spark):
    prepare(spark)
    rows = [
        (0, [1.0, 0.0], 1, "a"), (0, [1.0, 0.0], 1, "a"), (50, [0.5, 0.5], 2, None), (1, [0.0, 2.0], None, "b"),
        (2, None, 1, "c"), (3, [0.0, 0.0], 1, "c"), (4, [float("nan"), 1.0], 1, "c"), (5, [float("inf"), 1.0], 1, "c"),
        (6, [None, 1.0], 1, "c"), (100, [1.0, 2.0, 3.0], 1, "c"), (None, [1.0, 1.0], 1, "c"), (7, [-0.0, 3.0], 1, "c"),
        (150, [], 1, "c"), (8, [1e300, 1e300], 1, "c"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, ids string")
    found = by_query(hnsw.nearest_neighbours(frame).collect())
    # 100 is alone in its length and has no candidates.
    assert set(found) == {0, 50}
    assert [j for j, _ in found[0]] == [8, 50, 1, 7] or [j for j, _ in found[0]] == [50, 8, 1, 7]
    assert {j for j, _ in found[50]} == {0, 1, 7, 8}
    assert hnsw.nearest_neighbours(frame.limit(0)).count() == 0
    alone = frame.filter("vec_id = 100")
    assert hnsw.nearest_neighbours(alone).count() == 0


def test_multiples_of_a_vector_tie_and_each_vector_of_an_id_is_a_query(spark):
    prepare(spark)
    rng = np.random.default_rng(9)
    one, other = rng.normal(size=(2, 8))
    rows = [(i, (one * 2.0 ** ((7 * i) % 41 - 20)).tolist()) for i in range(41)]
    rows += [(100, (one * 2.0**25).tolist()), (100, other.tolist())] + [(i, (other + 0.01 * rng.normal(size=8)).tolist()) for i in range(101, 110)]
    found = hnsw.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    first = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == 0)
    assert [i for rank, i in first if rank <= 5] == [1, 2, 3, 4, 5]
    assert sorted(r["rank"] for r in found if r["query_id"] == 100) == sorted([1, 2, 3, 4, 5] * 2)
