from __future__ import annotations

import random
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard

from tallyhouse.llm import passages, queries
from tests.llm.helpers import MIDDLE, documents, edge_documents, no_documents, read


def prose(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6)}" for _ in range(n)]


def test_compact_windows_by_brute_force():
    """One node for each value that is the least of a stretch of at least the length, with its largest such stretch
    up to the length on either side."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        values = rng.permutation(rng.integers(8, 120)).astype(np.uint64)
        length = int(rng.integers(1, 8))
        expected = set()
        for c, v in enumerate(values):
            left = c
            while left and values[left - 1] > v:
                left -= 1
            right = c + 1
            while right < len(values) and values[right] > v:
                right += 1
            if right - left >= length:
                expected.add((int(v), max(left, c - length + 1), min(right, c + length)))
        found = set(zip(*(x.tolist() for x in passages.compact_windows(values, length))))
        assert found == expected


def test_every_long_stretch_lies_in_the_window_of_its_minimum():
    values = np.random.default_rng(2).integers(0, 1 << 60, 300).astype(np.uint64)
    signature, start, end = passages.compact_windows(values, 46)
    windows = {int(s): (a, b) for s, a, b in zip(signature, start, end)}
    for i in range(0, 250):
        a, b = windows[int(values[i : i + 46].min())]
        assert a <= i and i + 46 <= b


def test_word_hashes_tell_words_apart():
    texts = ["One two\tone", None, "", " \n ", "two\x0bONE x" * 3, "é É a\x85b", "ab ba a b"]
    words = passages.Words([t if t is None else t.encode() for t in texts])
    low = [[w.lower() for w in (t or "").encode().split()] for t in texts]
    assert [len(words[i]) for i in range(len(words))] == [len(w) for w in low]
    names = {}
    for i, ws in enumerate(low):
        for w, h in zip(ws, words[i].tolist()):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_shared_passages_are_exact():
    rng = random.Random(3)
    common = prose(rng, 60)
    edited = common[:30] + ["changed"] + common[31:]
    left, right = prose(rng, 200), prose(rng, 90)

    def hashes(words):
        return passages.shingles(passages.Words([" ".join(words).encode()])[0])

    found = passages.shared_passages(hashes(left[:100] + common + left[100:]), hashes(right[:40] + edited + right[40:]))
    assert len(found) == 1
    start, end, other, last, score = found[0]
    assert (start, end + 4, other, last + 4) == (100, 160, 40, 100) and score >= 0.8
    # Two words in 60 apart leave too little in common for one passage, and the parts are too short.
    twice = common[:20] + ["x"] + common[21:40] + ["y"] + common[41:]
    assert passages.shared_passages(hashes(common), hashes(twice)) == []
    assert passages.shared_passages(hashes(common[:40]), hashes(common[:40])) == []


def test_planted_passages_in_many_documents(spark):
    rng = random.Random(4)
    shared, short, rare = prose(rng, 70), prose(rng, 30), prose(rng, 55)
    rows = []
    for i in range(300):
        words = prose(rng, 150)
        if i < 100:
            words[60:60] = shared
        elif i < 200:
            words[20:20] = short  # a line that many documents share is no passage
        elif i < 202:
            words[90:90] = rare
        elif i < 204:
            words = rare[:25] + ["edited"] + rare[26:]
        rows.append((i, " ".join(words)))
    rows += [(1000, rows[250][1]), (1001, rows[250][1].upper())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in passages.repeated_passages(frame).collect()}
    assert set(found) == {*range(100), *range(200, 204), 250, 1000, 1001}
    assert {found[i]["class_id"] for i in range(100)} == {0}
    assert {found[i]["class_id"] for i in range(200, 204)} == {200}
    assert {found[i]["class_id"] for i in (250, 1000, 1001)} == {250}
    assert all(found[i]["passages"] == "60:130" for i in range(100))
    assert found[250]["n_copies"] == 3 and found[250]["passages"] == "0:150"


def test_query_finds_all_verbatim_passages(spark):
    rows = {r["doc_id"] for r in queries.op2_compact_windows(spark, MIDDLE).collect()}
    seen = {}
    for d in documents(MIDDLE):
        words = (d["text"] or "").lower().split()
        for i in range(len(words) - 49):
            seen.setdefault(tuple(words[i : i + 50]), set()).add(d["doc_id"])
    expected = {i for ids in seen.values() if len(ids) > 1 for i in ids}
    assert len(expected) > 50 and expected <= rows


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    assert passages.repeated_passages(docs).count() == 0
    twice = docs.unionAll(docs.filter("doc_id = 6")).unionAll(docs.filter("doc_id = 6").selectExpr("CAST(NULL AS long)", *docs.columns[1:]))
    rows = passages.repeated_passages(twice).collect()
    assert sorted((r["doc_id"] or -1, r["class_id"], r["n_copies"]) for r in rows) == [(-1, 6, 3), (6, 6, 3), (6, 6, 3)]
    assert passages.repeated_passages(no_documents(spark)).count() == 0


def line_with_tails(rng, n_pairs, n_others, before=()):
    """A line that all texts hold, and pairs of texts that hold it with the same eleven further words: 55 words.

    By itself the line is none: 40 shingles in stretches of 46 have a similarity of 40 / 52."""
    line, texts = prose(rng, 44), []
    for _ in range(n_pairs):
        tail = prose(rng, 11)
        texts += [[*before, *prose(rng, 60), *line, *tail, *prose(rng, 40)] for _ in range(2)]
    texts += [[*before, *prose(rng, 60), *line, *prose(rng, 50)] for _ in range(n_others)]
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


def test_passages_whose_minima_fall_in_a_frequent_line(spark):
    frame = spark.createDataFrame(line_with_tails(random.Random(5), 30, 60), "doc_id long, text string")
    found = {r["doc_id"]: r for r in passages.repeated_passages(frame).collect()}
    assert set(found) == set(range(60))
    assert all(found[i]["class_id"] == i - i % 2 and found[i]["passages"] == "60:115" for i in found)


def test_linked_texts_keep_their_other_passages(spark):
    rng = random.Random(6)
    frame = spark.createDataFrame(line_with_tails(rng, 30, 60, prose(rng, 70)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in passages.repeated_passages(frame).collect()}
    assert len(found) == 120 and {r["class_id"] for r in found.values()} == {0}
    assert all("0:70" in r["passages"].split(",") for r in found.values())
    assert all(("130:185" in found[i]["passages"].split(",")) == (i < 60) for i in found)


def test_edited_copies_in_large_families(spark):
    rng = random.Random(7)
    rows = []
    for family in range(60):
        common = prose(rng, 55)
        for k in range(20):
            words = common if k < 10 else [*common[: 10 + 3 * (k - 10)], *prose(rng, 1), *common[11 + 3 * (k - 10) :]]
            rows.append((100 * family + k, " ".join([*prose(rng, 40), *words, *prose(rng, 40)])))
    found = {r["doc_id"]: r["class_id"] for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i - i % 100 for i, _ in rows}


def test_edits_at_every_position_are_found():
    rng = random.Random(8)

    def hashes(words):
        return passages.shingles(passages.Words([" ".join(words).encode()])[0])

    for n in (50, 52, 54, 60):
        common = prose(rng, n)
        for at in range(n):
            edited = [*common[:at], "edited", *common[at + 1 :]]
            a, b = hashes([*prose(rng, 60), *common, *prose(rng, 60)]), hashes([*prose(rng, 30), *edited, *prose(rng, 30)])
            kept = n - 4 - len(range(max(0, at - 4), min(at, n - 5) + 1))
            total = 2 * (n - 4) - kept
            assert kept / total < 0.8 or any(r[4] >= 0.8 for r in passages.shared_passages(a, b)), (n, at)
    # A passage with an edit in its middle, between text that matches loosely on both sides.
    common = prose(rng, 60)
    edited = [*common[:30], "edited", *common[31:]]
    sides = [prose(rng, 42) for _ in range(2)]
    loose = [[w if i % 14 < 6 else f"x{w}" for i, w in enumerate(s)] for s in sides]
    found = passages.shared_passages(hashes([*sides[0], *common, *sides[1]]), hashes([*loose[0], *edited, *loose[1]]))
    assert found and all(r[4] >= 0.8 for r in found)


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_against_brute_force(spark):
    """Texts of one passage each with random edits: every pair is compared by its sets; at least nine in ten are found."""
    rng = random.Random(11)
    texts = []
    for _ in range(60):
        base = prose(rng, rng.randint(80, 140))
        for _ in range(rng.randint(2, 4)):
            edited = list(base)
            for _ in range(rng.randint(0, 3)):
                edited[rng.randrange(len(edited))] = prose(rng, 1)[0]
            texts.append(edited)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    classes = {r["doc_id"]: r["class_id"] for r in passages.repeated_passages(frame.repartition(5)).collect()}
    near = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    assert len(near) > 40
    together = [(i, j) for i, j in near if i in classes and classes[i] == classes.get(j)]
    assert len(together) >= 0.9 * len(near)
    # Nobody is in a class without a near passage in common.
    apart = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) < 0.01]
    assert not [(i, j) for i, j in apart if i in classes and classes[i] == classes.get(j)]


def test_input_that_is_not_stored_gives_the_same(spark):
    frame = read(spark, MIDDLE, "documents")
    stored, dealt = (sorted(map(tuple, passages.repeated_passages(f).collect())) for f in (frame, frame.repartition(7)))
    assert stored == dealt and len(stored) > 100


def test_spans_of_a_text_are_disjoint(spark):
    rows = [(1, 2, 0, 60, 5, 65), (1, 3, 50, 120, 0, 70), (1, 4, 0, 55, 0, 55), (1, 5, 200, 260, 0, 60), (6, 1, 0, 61, 199, 260)]
    found = spark.createDataFrame(rows, "a long, b long, a_start int, a_end int, b_start int, b_end int")
    spans = sorted(map(tuple, passages.merged_spans(found).filter("text_key = 1").collect()))
    assert spans == [(1, 0, 120), (1, 199, 260)]


def test_shuffle_files_go_with_their_step(spark):
    """Nothing but stored steps is left on disk, whether or not the driver has collected its garbage."""
    rng = random.Random(12)
    common = prose(rng, 60)
    rows = [(i, " ".join([*prose(rng, 40), *common, *prose(rng, 40)])) for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    root = Path(spark.conf.get("spark.local.dir", "/tmp"))

    def files():
        return set(root.glob("blockmgr-*/*/shuffle_*.data"))

    setting = spark.conf.get(passages.CLEANUP, "false")
    earlier = files()
    result = passages.repeated_passages(frame)
    for _ in range(100):
        left = files() - earlier
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(passages.CLEANUP) == setting
    assert result.count() == 8


def test_small_groups_are_not_split(spark):
    """Three texts under a signature, of which two are representatives, are all compared at once; four are not."""
    rng = random.Random(13)
    three, four = prose(rng, 60), prose(rng, 60)
    texts = [" ".join([*prose(rng, 60), *common, *prose(rng, 60)]) for common, n in ((three, 3), (four, 4)) for _ in range(n)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    windows = passages.colliding_windows(frame, "text")
    key = {passages.text_key(passages.Words([t.encode()])[0]): i for i, t in enumerate(texts)}
    by_group = {}
    for r in windows.collect():
        by_group.setdefault(r["group"], []).append((key[r["text_key"]], len(r["representatives"]), r["large"]))
    small = [rows for rows in by_group.values() if {i for i, *_ in rows} <= {0, 1, 2}]
    assert small and not any(large for rows in small for *_, large in rows)
    whole = [rows for rows in by_group.values() if {i for i, *_ in rows} == {3, 4, 5, 6}]
    assert whole and all(large == (n == 2 or n == 1) for rows in whole for _, n, large in rows)


def test_feasible_keeps_every_passage():
    """Stretches without a passage's length of enough matches are left out, all others are kept, repeats included."""
    rng = np.random.default_rng(14)
    ruled_out = 0
    for _ in range(100):
        n = int(rng.integers(40, 160))
        matched = rng.random(n) < rng.choice([0.6, 0.75, 0.9])
        before = np.full(n, -1)
        whole = any(
            matched[x:y].sum() >= passages.SIMILARITY * (y - x)
            for x in range(n)
            for y in range(x + passages.LENGTH, n + 1)
        )
        assert passages.feasible(matched, before, 0, n) == whole
        ruled_out += not whole
        # Repeats of unmatched shingles may make up for nothing.
        before[rng.random(n) < 0.2] = 0
        assert passages.feasible(matched, before, 0, n) >= whole
    assert 0 < ruled_out < 100


def test_texts_of_a_batch_are_hashed_together_and_places_tried_once(monkeypatch):
    """A pair costs no hashing of its own, and a place of two texts is tried once however often it comes up."""
    made, tried = [], []
    words, passage_at = passages.Words.__init__, passages.Pair.passage_at
    monkeypatch.setattr(passages.Words, "__init__", lambda self, texts: made.append(len(texts)) or words(self, texts))
    monkeypatch.setattr(
        passages.Pair, "passage_at", lambda self, before, *place: tried.append((self, place)) or passage_at(self, before, *place)
    )
    body, junk = [f"w{i}" for i in range(180)], [f"x{i}" for i in range(180)]
    # The second text has the parts of the first in another order and apart, the third only a few words of it.
    apart = body[60:120] + junk[:90] + body[:60] + junk[90:] + body[120:]
    texts = [" ".join(body), " ".join(apart), " ".join(body[:20] + [f"y{i}" for i in range(90)])]
    packed = [zstandard.compress(t.encode()) for t in texts]
    rows = [(0, 1), (0, 2), (1, 2)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in rows]), pa.array([b for _, b in rows]), pa.array([packed[a] for a, _ in rows]), pa.array([packed[b] for _, b in rows])],
        names=["a", "b", "a_body", "b_body"],
    )
    found = [row for out in passages.verify(iter([batch])) for row in out.to_pylist()]
    assert sorted(made) == [2, 3]
    assert len(tried) == len(set(tried))
    spans = [(r["a"], r["b"], r["a_start"], r["a_end"], r["b_start"], r["b_end"]) for r in found]
    assert sorted(spans) == [(0, 1, 0, 60, 150, 210), (0, 1, 60, 120, 0, 60), (0, 1, 120, 180, 300, 360)]
