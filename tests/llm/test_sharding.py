from __future__ import annotations

import zlib
from collections import Counter

from tallyhouse.llm import queries, sharding
from tests.llm.helpers import SMALL, documents, edge_documents, no_documents


def test_longest_first_by_hand():
    assert sharding.longest_first([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_matches_the_plain_schedule(spark):
    """With fewer groups than items of the heap, every large enough group is scheduled by itself."""
    rows = queries.op4_lpt_shards(spark, SMALL).collect()
    texts = {d["doc_id"]: d["text"] for d in documents(SMALL)}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    load, of_text, slots = Counter(), {}, {}
    for r in rows:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 8, zlib.crc32(body))
        assert of_text.setdefault(body, r["shard"]) == r["shard"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    groups = Counter()
    for d in documents(SMALL):
        groups[d["text"]] += len((d["text"] or "").encode()) + 8
    plain = Counter()
    for text, shard in sharding.longest_first([(n, t) for t, n in groups.items()], 24).items():
        plain[shard] += groups[text]
    assert max(load.values()) <= max(plain.values()) * 1.02 and set(load) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_many_small_groups_are_bundled(spark):
    frame = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS text").unionAll(
        spark.range(10_000).selectExpr("id + 20000 AS doc_id", "'the same text again' AS text")
    )
    rows = sharding.shard_documents(frame, shards=4).collect()
    assert len({r["shard"] for r in rows if r["doc_id"] >= 20_000}) == 1
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert len(rows) == 30_000 and sum(load.values()) == sum(r["size"] for r in rows)
    # The shard of the hot group holds nothing but it if it outweighs a fair share; the others are level.
    rest = sorted(load.values())[:-1]
    assert max(rest) - min(rest) <= 0.01 * sum(load.values())


def test_awkward_rows(spark):
    rows = sharding.shard_documents(edge_documents(spark), shards=3).collect()
    assert len(rows) == 9
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (1, 2)} == {(8, 0)}
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.shard_documents(no_documents(spark)).count() == 0
