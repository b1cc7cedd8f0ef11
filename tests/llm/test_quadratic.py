from __future__ import annotations

import numpy as np
import pytest

from tallyhouse.llm import quadratic, queries
from tests.llm.helpers import MIDDLE, edge_documents, no_documents, read


def test_held_out_accuracy(spark):
    rows = queries.op10_quadratic(spark, MIDDLE).join(read(spark, MIDDLE, "labels"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 30
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_sums_give_the_sample_covariance(spark):
    rng = np.random.default_rng(1)
    d = len(quadratic.FEATURES)
    x = {0: rng.normal(0, 1, (40, d)), 1: rng.normal(1, 2, (60, d))}
    frame = spark.createDataFrame([(row.tolist(), c) for c in x for row in x[c]], "x array<double>, c int")
    sums = quadratic.class_sums(frame, "c")
    for c in x:
        assert sums[c][0] == len(x[c])
        assert np.allclose(sums[c][1], x[c].sum(axis=0))
        assert np.allclose(sums[c][2], x[c].T @ x[c])


def test_probability_is_the_density_ratio():
    rng = np.random.default_rng(2)
    d = len(quadratic.FEATURES)
    x = {0: rng.normal(0, 1, (200, d)), 1: rng.normal(0.5, 1.5, (300, d))}
    sums = {c: (float(len(v)), v.sum(axis=0), v.T @ v) for c, v in x.items()}
    model = quadratic.fit_sums(sums, pooled_share=0.0, identity_share=0.0)

    def density(v, c):
        mean, cov = x[c].mean(axis=0), np.cov(x[c].T, bias=True)
        away = v - mean
        return np.log(len(x[c])) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * away @ np.linalg.solve(cov, away)

    point = rng.normal(0.2, 1, d)
    expected = 1 / (1 + np.exp(density(point, 0) - density(point, 1)))
    assert model.probability(point[None])[0] == pytest.approx(expected, rel=1e-9)


def test_awkward_rows_and_labels(spark):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (2, None, None), (99, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quadratic.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quadratic.classify(docs, none).collect()} == {0.5}
    only = spark.createDataFrame([(i, 1) for i in range(1, 7)], "doc_id long, quality int")
    assert {r["score"] for r in quadratic.classify(docs, only).collect()} == {1.0}
    assert quadratic.classify(no_documents(spark), labels).count() == 0
    kept = quadratic.accepted(docs, only)
    assert kept.columns == docs.columns and kept.count() == docs.count()
