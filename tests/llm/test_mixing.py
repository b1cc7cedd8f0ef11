from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import mixing, queries
from tests.llm.helpers import SMALL, documents, edge_documents, no_documents, read


@pytest.mark.parametrize("seed", range(8))
def test_every_prefix_is_within_one_block(seed):
    rng = random.Random(seed)
    weights = mixing.whole_weights({f"s{i}": rng.random() ** 3 + 1e-4 for i in range(rng.randint(2, 12))}, 300)
    assert sum(weights.values()) == 300 and min(weights.values()) >= 1
    placed = mixing.one_period(weights)
    by_slot = {slot: k for k, slots in placed.items() for slot in slots}
    assert sorted(by_slot) == list(range(300))
    done = Counter()
    for slot in range(300):
        done[by_slot[slot]] += 1
        for k, w in weights.items():
            assert abs(done[k] - Fraction(w * (slot + 1), 300)) < 1
    for k, slots in placed.items():
        for j, slot in enumerate(slots, 1):
            assert (j - 1) * 300 // weights[k] <= slot < -(-j * 300 // weights[k])


def test_phases_use_every_block_once():
    blocks = {"a": 50, "b": 7, "c": 1}
    plan = mixing.phases(blocks, {"a": 1.0, "b": 1.0, "c": 2.0}, 20)
    slots = []
    for k, n in blocks.items():
        for b in range(n):
            first, _, start, period, table = next(p for p in plan[k] if p[0] <= b < p[0] + p[1])
            turns, rest = divmod(b - first, len(table))
            slots.append(start + turns * period + table[rest])
    assert sorted(slots) == list(range(58))


def test_query_keeps_all_rows_in_one_gapless_order(spark):
    rows = sorted(queries.op5_pfair_mix(spark, SMALL).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(len(rows)))
    assert sorted(r["doc_id"] for r in rows) == sorted(d["doc_id"] for d in documents(SMALL))
    assert [r["slot"] for r in rows] == sorted(r["slot"] for r in rows)
    for source in {r["source"] for r in rows}:
        blocks = [r["block"] for r in rows if r["source"] == source]
        assert blocks == sorted(blocks)


def test_targets_hold_until_a_source_runs_out(spark):
    frame = spark.range(9000).selectExpr("id AS doc_id", "if(id < 6000, 'big', if(id < 8000, 'mid', 'low')) AS source")
    rows = mixing.mix(frame, {"big": 0.5, "mid": 0.3, "low": 0.2}, block_rows=10, slots=100).collect()
    by_slot = {r["slot"]: r["source"] for r in rows}
    done = Counter()
    for slot in range(500):  # the low source has 100 blocks, enough for 500 slots
        done[by_slot[slot]] += 1
        for k, w in {"big": 0.5, "mid": 0.3, "low": 0.2}.items():
            # Weights are rounded to whole slots of a period, less than one block in each.
            assert abs(done[k] - w * (slot + 1)) < 1 + 5


def test_mixed_documents_follow_the_order(spark):
    docs = read(spark, SMALL, "documents")
    order = [r["doc_id"] for r in mixing.mix(docs, block_rows=4).orderBy("position").collect()]
    mixed = mixing.mixed(docs, block_rows=4, rows_per_file=50)
    assert mixed.columns == docs.columns
    assert [r["doc_id"] for r in mixed.collect()] == order


def test_awkward_rows(spark):
    rows = mixing.mix(edge_documents(spark), {"a": 2.0, None: 1.0}).collect()
    assert sorted(r["position"] for r in rows) == list(range(9))
    assert sum(r["source"] is None for r in rows) == 3
    assert mixing.mix(no_documents(spark)).count() == 0
    assert mixing.mixed(no_documents(spark)).count() == 0


def test_extra_columns_and_rows_that_are_not_stored(spark):
    """Helper columns take names the documents do not have; a shuffled input is mixed like a stored one."""
    docs = edge_documents(spark)
    mixed = mixing.mixed(docs, block_rows=2).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, docs.collect()))
    big = read(spark, SMALL, "documents").withColumn("_place", F.lit(5)).withColumn("_position", F.lit(6))
    mixed = mixing.mixed(big.repartition(7), block_rows=4).collect()
    assert {(r["_place"], r["_position"]) for r in mixed} == {(5, 6)}
    assert sorted(r["doc_id"] for r in mixed) == sorted(d["doc_id"] for d in documents(SMALL))
