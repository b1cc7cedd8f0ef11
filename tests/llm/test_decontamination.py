from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tallyhouse.llm import decontamination, queries
from tallyhouse.llm.common import prepare
from tests.llm.helpers import MIDDLE, documents, edge_documents, no_documents, read


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(texts, items, window=10):
    """(words, hit words, items) of each text; every window looked up in every place."""
    windows = {}
    for item, text in items:
        words = plain_words(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for text in texts:
        words, hit, met = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    met |= found
        out.append((len(words), len(hit), sorted(met)))
    return out


def digest(row):
    return (row[0], row[1], len(row[2]), hashlib.sha256(",".join(row[2]).encode()).hexdigest(), row[1] > 0)


def benchmark_of(spark, items):
    return prepare(spark).createDataFrame(items, "item_id long, text string")


def test_query_by_brute_force(spark):
    docs = sorted(documents(MIDDLE), key=lambda d: d["doc_id"])
    items = [(r["item_id"], r["text"]) for r in read(spark, MIDDLE, "benchmark").collect()]
    rows = sorted(queries.op13_suffix_arrays(spark, MIDDLE).collect(), key=lambda r: r["doc_id"])
    expected = [digest(r) for r in plain([d["text"] for d in docs], items)]
    assert [tuple(r)[1:] for r in rows] == expected
    assert 0 < sum(r["contaminated"] for r in rows) < len(rows)


def invented(seed, n_texts=60, longest=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 4, 10, 11, 25, 60])))) for i in range(12)]
    texts = []
    for _ in range(n_texts):
        body = rng.choices([*words, "Other", "É?"], k=rng.randint(0, longest))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(body))
            part = rng.choice(items)[1].upper().split()
            start = rng.randint(0, max(0, len(part) - 10))
            body[at:at] = part[start : start + rng.randint(5, 40)]
        texts.append(rng.choice([" ", ", ", "\n--"]).join(body))
    return texts, items


@pytest.mark.parametrize("seed,window,shard", [(0, 10, 1 << 20), (1, 10, 64), (2, 3, 16), (3, 10, 11), (4, 1, 7)])
def test_shards_of_any_size(seed, window, shard):
    """Texts within a shard, and texts that go on over many shards."""
    texts, items = invented(seed)
    tests = decontamination.Suffixes([(str(i), 0, decontamination.words_of(t.encode())) for i, t in items if t], window)
    found = list(decontamination.in_texts((t.encode() for t in texts), tests, shard))
    for (n, places, windows), (words, hits, met) in zip(found, plain(texts, items, window), strict=True):
        spans = decontamination.spans_of(places, tests.lengths[windows])
        assert (n, sum(b - a for a, b in spans)) == (words, hits)
        assert sorted(set().union(*[tests.items_of[w] for w in windows])) == met


def test_suffix_array_is_sorted_and_searched():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 4, 3000).astype(np.int32)
    array = decontamination.suffix_array(words, 10, 3)
    padded = np.append(words, np.zeros(16, np.int32)).tolist()
    order = [tuple(itertools.takewhile(bool, padded[p : p + 10])) for p in array]
    assert order == sorted(order)
    runs = [p for p in range(3000) if all(padded[p : p + 3])]
    assert sorted(array.tolist()) == runs


def test_benchmark_in_several_blocks_gives_the_same(spark):
    texts, items = invented(7)
    items += [(3, items[4][1]), (None, items[5][1] or "w1 w2")]
    rows = [(i % 50, t) for i, t in enumerate(texts)] + [(1, texts[1])]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    benchmark = benchmark_of(spark, items)
    expected = sorted((i, *digest(r)) for (i, _), r in zip(rows, plain([t for _, t in rows], [(i if i is not None else "", t) for i, t in items])))
    for block_words in (1 << 18, 20):
        found = decontamination.digests(decontamination.contamination(docs, benchmark, block_words=block_words))
        assert sorted(map(tuple, found.collect())) == expected
        left = decontamination.decontaminated(docs, benchmark, block_words=block_words)
        assert sorted(map(tuple, left.collect())) == sorted(r for r, e in zip(rows, plain([t for _, t in rows], items)) if not e[1])


def test_long_items_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 16)
    texts, items = invented(8)
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.digests(decontamination.contamination(docs, benchmark_of(spark, items)))
    assert [tuple(r)[1:] for r in found.orderBy("doc_id").collect()] == [digest(r) for r in plain(texts, items)]


def test_longest_matches_and_places(spark):
    item = " ".join(f"t{i}" for i in range(30))
    text = "intro " + " ".join(f"t{i}" for i in range(4, 19)) + " gap " + " ".join(f"t{i}" for i in range(2, 11)) + " gap " + item
    docs = prepare(spark).createDataFrame([(1, text), (2, "nothing of it"), (3, None)], "doc_id long, text string")
    found = decontamination.verbatim_matches(docs, benchmark_of(spark, [(5, item)]))
    assert sorted(map(tuple, found.collect())) == [(1, "5", 1, 4, 15), (1, "5", 27, 0, 30)]


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    benchmark = benchmark_of(spark, [(1, None), (2, ""), (3, " \n-"), (4, "ONE two"), (None, "word3 and word4 and word5 and word6 and word7 and word8")])
    rows = decontamination.digests(decontamination.contamination(docs, benchmark)).collect()
    hit = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in rows}
    assert len(rows) == 9 and hit[4] == (3, 2, 1) == hit[5] and hit[1] == (0, 0, 0)
    assert hit[6] == (60_000, 31 * 11, 1)
    left = decontamination.decontaminated(docs, benchmark)
    assert left.columns == docs.columns and left.count() == 5
    assert decontamination.contamination(no_documents(spark), benchmark).count() == 0
    empty = benchmark_of(spark, [])
    assert not any(r["contaminated"] for r in decontamination.digests(decontamination.contamination(docs, empty)).collect())
    assert decontamination.verbatim_matches(docs, empty).count() == 0
