from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import queries, simhash
from tests.llm.helpers import MIDDLE, documents, edge_documents, no_documents, read


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    names = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and names[i] != names[j]:
                old, new = max(names[i], names[j]), min(names[i], names[j])
                names = [new if n == old else n for n in names]
    return names


def test_query_by_brute_force(spark):
    rows = {r["doc_id"]: r for r in queries.op6_simhash_anchors(spark, MIDDLE).collect()}
    docs = sorted(documents(MIDDLE), key=lambda d: d["doc_id"])
    prints = [plain_fingerprint(d["text"]) for d in docs]
    for d, p, n in zip(docs, prints, plain_components(prints)):
        assert rows[d["doc_id"]]["fingerprint"] == f"{p:016x}"
        assert rows[d["doc_id"]]["component_id"] == docs[n]["doc_id"]


def test_every_point_has_one_anchor_within_the_radius():
    home, words = simhash.code()
    assert (home >= 0).all()
    points = np.arange(1 << 23)
    assert np.bitwise_count(points ^ words[home]).max() == simhash.CODE_RADIUS


def test_anchors_within_radius_and_threshold():
    _, words = simhash.code()
    rng = np.random.default_rng(5)
    points = rng.integers(0, 1 << 23, 200)
    found = [set() for _ in points]
    for rows, anchors, _ in simhash.anchors(points):
        for r, a in zip(rows, anchors):
            assert a not in found[r]
            found[r].add(int(a))
    for p, anchors in zip(points, found):
        assert anchors == set(np.flatnonzero(np.bitwise_count(words ^ p) <= simhash.CODE_RADIUS + 1).tolist())


def test_near_points_meet_at_the_home_of_one_of_them():
    """Both codes: of points that differ in 4 bits, wherever, one is replicated to the home of the other."""
    rng = np.random.default_rng(8)
    for fine in (False, True):
        chosen = simhash.covers(fine, 4)
        assert len(chosen) == (15 if fine else 3)
        for _ in range(30):
            one = int(rng.integers(0, 1 << 63, dtype=np.uint64)) << 1 | 1
            other = one ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            batch = pa.record_batch([pa.array([simhash.signed(one), simhash.signed(other)], pa.int64())], names=["fp"])
            made = [r for b in simhash.replicate(iter([batch]), chosen) for r in b.to_pylist()]
            homes = {r["anchor"] for r in made if r["home"] and r["fp"] == simhash.signed(one)}
            assert len(homes) == len(chosen)
            assert homes & {r["anchor"] for r in made if r["fp"] == simhash.signed(other)}
            assert len({(r["anchor"], r["fp"]) for r in made}) == len(made)


@pytest.mark.parametrize("cell, share, coarse", [(2048, 16_384, 1 << 23), (7, 16_384, 1 << 23), (7, 11, 1 << 23), (2048, 16_384, 0), (2, 3, 0)])
def test_dense_families_by_brute_force(spark, monkeypatch, cell, share, coarse):
    monkeypatch.setattr(simhash, "CELL_POINTS", cell)
    monkeypatch.setattr(simhash, "CELL_REPLICAS", share)
    monkeypatch.setattr(simhash, "COARSE_POINTS", coarse)
    rng = np.random.default_rng(6)
    prints = []
    for centre in rng.integers(0, 1 << 63, 12, dtype=np.uint64):
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            prints.append(int(centre) ^ sum(1 << int(b) for b in flips))
    prints = list(dict.fromkeys([*prints, 0, 15, (1 << 64) - 1]))
    frame = spark.createDataFrame([(i, simhash.signed(p)) for i, p in enumerate(prints)], "doc_id long, fp long")
    rows = {r["fp"]: r["component_id"] for r in simhash.labelled(frame, 4).collect()}
    assert [rows[simhash.signed(p)] for p in prints] == plain_components(prints)


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 9
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"0" * 16}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5)} == {4}
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))[0]["doc_id"] == 1
    assert kept.filter("doc_id = 4").count() == 1 and kept.filter("doc_id IN (2, 3, 5)").count() == 0
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_deduplicated_keeps_columns_and_takes_any_input(spark):
    docs = read(spark, MIDDLE, "documents").withColumn("_place", F.lit(5)).withColumn("_position", F.lit(6))
    kept = simhash.deduplicated(docs).collect()
    again = simhash.deduplicated(docs.repartition(7)).collect()
    assert {(r["_place"], r["_position"]) for r in kept} == {(5, 6)}
    assert sorted(map(repr, kept)) == sorted(map(repr, again))
    assert sorted(r["doc_id"] for r in kept) == sorted({r["component_id"] for r in queries.op6_simhash_anchors(spark, MIDDLE).collect()})
