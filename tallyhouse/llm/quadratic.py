"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Every text becomes a short vector of counts and ratios, transformed so that each is roughly bell-shaped.
Class means and covariances come from sums over all labelled training rows, gathered by Spark; only those
sums reach the driver. The covariance of a class is shrunk towards the pooled one and then towards a
multiple of the identity. A score is the probability that the difference of the two log densities gives,
each a Mahalanobis distance through a Cholesky factor computed once.

Defined cases: a null text counts as empty; an empty text has the vector of zeros and gets a score; without
any training label all scores are 0.5; with labels of one class only they are that class. A document
labelled twice counts once in each class it was given. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import crc_of_id, cut, map_texts

FEATURES = (
    "log_words",
    "log_word_length",
    "upper",
    "symbols",
    "exclamations",
    "pipes",
    "digits",
    "punctuation",
    "not_ascii",
    "distinct_words",
    "adjacent_equal",
    "equal_lines",
    "byte_entropy",
)

# Share of the pooled covariance in a class's, and of the identity in the result.
POOLED_SHARE = 0.1
IDENTITY_SHARE = 0.02
THRESHOLD = 0.3


def statistics(text: bytes | None) -> list[float]:
    """The vector of one text, in the order of FEATURES."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total = int(counts.sum())
    white = int(counts[9:14].sum() + counts[32])
    solid = total - white
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    symbols = int(counts[list(b"#*$%&|<>")].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    shares = counts[counts > 0] / total
    characters = max(1, solid - int(counts[128:192].sum()))
    return [
        np.log1p(n),
        np.log(characters / n),
        np.sqrt(upper / max(1, upper + lower)),
        np.sqrt(symbols / n),
        np.sqrt(int(counts[33]) / n),
        np.sqrt(int(counts[124]) / n),
        np.sqrt(int(counts[48:58].sum()) / solid),
        np.sqrt(int(counts[list(b".,;:?")].sum()) / n),
        np.sqrt(int(counts[128:].sum()) / solid),
        np.log(n) - np.log(len(set(words))),
        np.sqrt(sum(map(eq, words, words[1:])) / n),
        np.sqrt((len(lines) - len(set(lines))) / len(lines)),
        float(-(shares * np.log2(shares)).sum()),
    ]


def document_vectors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the vector of every document, read whole."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_texts(
        rows,
        "text",
        "doc_id long, x array<double>",
        {"x": pa.list_(pa.float64())},
        lambda texts: [[statistics(t) for t in texts]],
    )


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of the two classes, in standardised coordinates."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    constant: float | None = None

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of x."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = (x - self.centre) / self.scale
        density = [
            offset - 0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def class_sums(vectors: DataFrame, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each class the number of rows, the sum of x and the sum of x x', added up by Spark."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.col("x")[i] for i in range(d)]
    rows = (
        vectors.groupBy(F.col(label).alias("_class"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.array(*[F.sum(v) for v in x]).alias("_s"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("_p"),
        )
        .collect()
    )
    sums = {}
    for row in rows:
        products = np.zeros((d, d))
        for (i, j), value in zip(pairs, row["_p"]):
            products[i, j] = products[j, i] = value
        sums[int(row["_class"])] = (float(row["_n"]), np.array(row["_s"]), products)
    return sums


def fit_sums(
    sums: dict[int, tuple[float, np.ndarray, np.ndarray]],
    pooled_share: float = POOLED_SHARE,
    identity_share: float = IDENTITY_SHARE,
) -> Discriminant:
    """The discriminant from the sums of ``class_sums``."""
    d = len(FEATURES)
    empty = np.zeros((2, d))
    if len(sums) < 2:
        constant = float(next(iter(sums))) if sums else 0.5
        return Discriminant(empty[0], empty[0] + 1, empty, np.zeros((2, d, d)), np.zeros(2), constant)
    n = sum(s[0] for s in sums.values())
    centre = sum(s[1] for s in sums.values()) / n
    spread = np.diag(sum(s[2] for s in sums.values()) / n) - centre**2
    scale = np.sqrt(np.maximum(spread, 0))
    scale[scale < 1e-6] = 1
    covariances, means = [], []
    for label in (0, 1):
        count, total, products = sums[label]
        mean = total / count
        covariances.append((products / count - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = sum(sums[label][0] / n * covariances[label] for label in (0, 1))
    factors, offsets = [], []
    for label in (0, 1):
        shrunk = (1 - pooled_share) * covariances[label] + pooled_share * pooled
        level = max(np.trace(shrunk) / d, 1e-6)
        shrunk = (1 - identity_share) * shrunk + identity_share * level * np.eye(d)
        cholesky = np.linalg.cholesky((shrunk + shrunk.T) / 2)
        factors.append(np.linalg.inv(cholesky))
        offsets.append(np.log(sums[label][0] / n) - np.log(np.diag(cholesky)).sum())
    return Discriminant(centre, scale, np.array(means), np.array(factors), np.array(offsets))


def fit(vectors: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Discriminant:
    """Learn from the labelled rows outside the held-out fold; labels (doc_id, quality) other than 0 and 1 are ignored."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("_label"))
        .filter(F.col("_label").isin(0, 1) & (crc_of_id("doc_id") % folds != held_out))
        .distinct()
    )
    return fit_sums(class_sums(vectors.join(known, "doc_id"), "_label"))


def scored(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) of every vector."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            score = model.probability(x) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return vectors.select("doc_id", "x").mapInArrow(batches, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    vectors = cut(document_vectors(docs))
    model = fit(vectors, labels)
    return scored(vectors, model).select(
        "doc_id",
        (crc_of_id("doc_id") % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns. Only vectors meet the labels; each text is
    scored where it lies, so no text is shuffled."""
    model = fit(cut(document_vectors(docs)), labels)
    columns = docs.columns
    place = columns.index("text")

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                texts = batch.column(place).cast(pa.binary()).to_pylist()
                score = model.probability(np.array([statistics(t) for t in texts]))
                yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(batches, docs.schema)
