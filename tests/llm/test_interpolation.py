from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import interpolation, queries
from tests.llm.helpers import SMALL, documents, edge_documents, no_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def counts(docs):
    words, pairs = Counter(), Counter()
    for t in docs:
        words.update(["\t", *t])
        pairs.update(zip(["\t", *t], t))
    n = sum(words.values()) - words["\t"]
    return words, pairs, n, len(words) - ("\t" in words)


def plain_scores(docs):
    """Base and model score of every (doc_id, text), with counters and a loop."""
    texts = [tokens_of(t) for _, t in docs]
    folds = [fold(i) for i, _ in docs]
    words, pairs, n, v = counts([t for t, f in zip(texts, folds) if f not in (2, 3)])
    cells = Counter()
    for t, f in zip(texts, folds):
        if f == 3:
            for a, b in zip(["\t", *t], t):
                p2, p1, p0 = interpolation.likelihoods(np.array([pairs[a, b]]), np.array([words[a]]), np.array([words[b]]), n, v)
                bucket = int(interpolation.context_bucket(np.array([words[a]]))[0])
                cells[bucket, int(interpolation.ratio_bins(p2, p0)[0]), int(interpolation.ratio_bins(p1, p0)[0])] += 1
    weights = interpolation.learn([(*k, c) for k, c in cells.items()])
    words, pairs, n, v = counts([t for t, f in zip(texts, folds) if f != 2])
    out = []
    for t in texts:
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in t)
        model = 0.0
        for a, b in zip(["\t", *t], t):
            w = weights[math.frexp(words[a])[1]]
            model += math.log10(w[0] * pairs[a, b] / max(words[a], 1) + w[1] * words[b] / max(n, 1) + w[2] / (v + 1))
        out.append((len(t), sum(words[w] > 0 for w in t), n, base, model))
    return out


def agree(rows, docs):
    expected = sorted(zip([(d is None, d or 0) for d, _ in docs], plain_scores(docs)))
    rows = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["base_score"]))
    expected.sort(key=lambda x: (x[0], x[1][0], x[1][3]))
    assert len(rows) == len(expected)
    for r, ((missing, doc_id), (n, known, total, base, model)) in zip(rows, expected):
        assert r["doc_id"] == (None if missing else doc_id)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["held_out"] == (fold(r["doc_id"]) == 2)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model, rel=1e-9)


def test_query_by_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in documents(SMALL)]
    agree(queries.op8_deleted_interpolation(spark, SMALL).collect(), docs)


def test_many_chunks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(interpolation, "BUCKET_TOKENS", 5_000)
    frame = spark.createDataFrame([(d["doc_id"], d["text"]) for d in documents(SMALL)], "doc_id long, text string")
    docs = [(r[0], r[1]) for r in frame.collect()]
    agree(interpolation.score_documents(frame.repartition(5)).collect(), docs)


def test_model_predicts_held_out_text_better(spark):
    rows = [r for r in queries.op8_deleted_interpolation(spark, SMALL).collect() if r["held_out"]]
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_weights_maximise_the_likelihood():
    cells = [(3, 0, 120, 50), (3, 160, 120, 30), (3, 0, 0, 5), (4, 150, 140, 9)]

    def likelihood(w):
        a, b = interpolation.bin_ratio(np.array([0, 160, 0])), interpolation.bin_ratio(np.array([120, 120, 0]))
        return (np.array([50, 30, 5]) * np.log(w[0] * a + w[1] * b + w[2])).sum()

    best = interpolation.learn(cells, 500)[3]
    assert best.sum() == pytest.approx(1)
    rng = np.random.default_rng(1)
    assert all(likelihood(best) >= likelihood(w) - 1e-3 for w in rng.dirichlet([1, 1, 1], 2000))


def test_packing():
    values = np.array([0, 1, 255, 256, 2**32 - 1], np.uint32)
    assert (interpolation.unpacked(interpolation.packed(values)) == values).all()
    assert len(interpolation.unpacked(interpolation.packed(values[:0]))) == 0
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 999, np.uint64))
    assert (interpolation.unpacked_hashes(interpolation.packed_hashes(hashes)) == hashes).all()
    assert len(interpolation.unpacked_hashes(interpolation.packed_hashes(hashes[:0]))) == 0


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    agree(interpolation.score_documents(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert interpolation.score_documents(no_documents(spark)).count() == 0
    held = next(i for i in range(99) if fold(i) == 2)
    alone = spark.createDataFrame([(held, "no training text")], "doc_id long, text string")
    row = interpolation.score_documents(alone).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
