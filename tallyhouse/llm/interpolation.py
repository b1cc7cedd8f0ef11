"""Language-model scores by deleted interpolation of bigrams, unigrams and the uniform distribution.

P(w | v) = a(c(v)) c(v w) / c(v) + b(c(v)) c(w) / N + (1 - a - b) / (V + 1), where the weights depend on the bucket
(power of two) of the context's count. They are learned by expectation-maximisation on one fold of the training
documents, against counts from the other folds; scores then use the counts of all training documents.

How it runs: a task turns texts into chunks - a chunk's distinct words, and its tokens as numbers of these - and
asks for the counts of its distinct words and bigrams. The requests are arrays of 64-bit hashes, dealt to
buckets by hash, so a word is asked for once per chunk however often it occurs and the most frequent word costs
no more than a rare one. A bucket adds up what its chunks hold, which is the count over the whole corpus, and
answers every chunk. The answers are joined to the chunks, and each document gets, per token, c(v w) and c(w).
Bucket numbers follow from the number of tokens, so a bucket stays as small as a chunk at any input size.

Defined cases: a null text counts as empty; an empty text is one end token; a document without an id hashes as
the empty text; without training documents N = V = 0 and only the uniform part is left; repeated rows count as
often as they occur and get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import crc_of_id, cut

FOLDS, HELD_OUT, TUNING = 7, 2, 3
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# No word holds white space, so these are tokens of their own.
END, START = b"\n", b"\t"
CHUNK_TOKENS = 3_000_000
BUCKET_TOKENS = 4_000_000
CONTEXT_BUCKETS = 40
EM_ROUNDS = 30
# Bins of the two likelihood ratios that EM sees, in steps of 1 / RATIO_STEPS of a power of two.
RATIO_BINS, RATIO_STEPS = 400, 6

CHUNK = (
    "chunk long, is_tuning boolean, doc_ids array<long>, folds array<int>, ends array<int>, start int, tokens binary, "
    "word_hashes binary"
)
CHUNK_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("is_tuning", pa.bool_()),
        ("doc_ids", pa.list_(pa.int64())),
        ("folds", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
        ("start", pa.int32()),
        ("tokens", pa.binary()),
        ("word_hashes", pa.binary()),
    ]
)
WORDS, PAIRS = 1, 2
REQUEST = "bucket int, kind int, chunk long, hashes binary, main binary, tuning binary"
REQUEST_ARROW = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int64())]
    + [(name, pa.binary()) for name in ("hashes", "main", "tuning")]
)
ANSWER = "chunk long, kind int, bucket int, main binary, tuning binary, types_train long, types_main long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def packed_hashes(values: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as compressed differences, the first bytes of all of them together, and so on."""
    gaps = np.diff(values, prepend=np.uint64(0))
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked_hashes(data: bytes) -> np.ndarray:
    parts = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(parts).view(np.uint64).ravel(), dtype=np.uint64)


def packed(values: np.ndarray) -> bytes:
    """32-bit numbers, compressed; the first bytes of all numbers stand together, then the second, and so on."""
    parts = np.ascontiguousarray(values, np.uint32).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(parts.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    parts = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(parts).view(np.uint32).ravel()


def mix(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each pair of hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + (first >> np.uint64(29)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Builder:
    """Collects documents until they make a chunk; a document is never cut."""

    def __init__(self, is_tuning: bool):
        self.is_tuning = is_tuning
        self.words: dict[bytes, int] = {START: 0, END: 1}
        self.doc_ids: list[int | None] = []
        self.folds: list[int] = []
        self.ends: list[int] = []
        self.tokens: list[np.ndarray] = []

    def add(self, doc_id: int | None, fold: int, text: bytes | None) -> bool:
        """Whether the chunk is full."""
        found = (text or b"").translate(LOWER).split()
        found.append(END)
        known, words = self.words.setdefault, self.words
        self.tokens.append(np.array([known(w, len(words)) for w in found], np.int64))
        self.doc_ids.append(doc_id)
        self.folds.append(fold)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(found))
        return self.ends[-1] >= CHUNK_TOKENS

    def batch(self, number: int) -> pa.RecordBatch:
        """The chunk as a row; its words are numbered in the order of their hashes."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = {
            "chunk": number,
            "is_tuning": self.is_tuning,
            "doc_ids": self.doc_ids,
            "folds": self.folds,
            "ends": self.ends,
            "start": int(place[0]),
            "tokens": packed(place[np.concatenate(self.tokens)]),
            "word_hashes": packed_hashes(hashes[order]),
        }
        return pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)


def chunked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, fold, text) to chunks of about CHUNK_TOKENS tokens; the tuning fold has chunks of its own."""
    number = TaskContext.get().partitionId() << 32
    open_chunks = {is_tuning: Builder(is_tuning) for is_tuning in (False, True)}
    for batch in stream:
        for doc_id, fold, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()
        ):
            mine = open_chunks[fold == TUNING]
            if mine.add(doc_id, fold, text):
                yield mine.batch(number)
                number += 1
                open_chunks[mine.is_tuning] = Builder(mine.is_tuning)
    for mine in open_chunks.values():
        if mine.doc_ids:
            yield mine.batch(number)
            number += 1


class Chunk:
    """The token stream of a chunk, with its distinct words and bigrams in the order of their hashes."""

    def __init__(self, row):
        self.ends = np.asarray(row["ends"], np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.folds = np.asarray(row["folds"], np.int64)
        words = unpacked_hashes(row["word_hashes"])
        self.tokens = unpacked(row["tokens"]).astype(np.int64)
        # A start mark stands before each document as its first context.
        self.start = row["start"]
        self.before = np.concatenate([[0], self.tokens[:-1]])
        self.before[self.starts] = self.start
        pairs, self.pairs = np.unique(mix(words[self.before], words[self.tokens]), return_inverse=True)
        self.hashes = {WORDS: words, PAIRS: pairs}

    def per_token(self, folds: np.ndarray) -> np.ndarray:
        return np.repeat(folds, self.ends - self.starts)

    def own_counts(self, kind: int, folds: np.ndarray) -> np.ndarray:
        """How often the chunk holds each word or bigram in documents of the given folds."""
        which = self.tokens if kind == WORDS else self.pairs
        counts = np.bincount(which[self.per_token(folds)], minlength=len(self.hashes[kind]))
        if kind == WORDS:
            counts[self.start] = folds.sum()
        return counts

    def counts(self, kind: int, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The corpus counts, in the main folds and the tuning fold, of every word or bigram of the chunk."""
        mine = answers[answers["kind"] == kind].sort_values("bucket")
        return tuple(np.concatenate([unpacked(b) for b in mine[name]]).astype(np.int64) for name in ("main", "tuning"))


def bucket_starts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, an equal range of hash values, starts in sorted hashes."""
    bounds = [(b << 64) // buckets for b in range(buckets)]
    return np.concatenate([np.searchsorted(hashes, np.array(bounds, np.uint64)), [len(hashes)]])


def requests(buckets: int):
    """The hashes each chunk asks for, with how often it holds them itself."""

    def ask(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                tuning = chunk.folds == TUNING
                main = ~tuning & (chunk.folds != HELD_OUT)
                for kind, hashes in chunk.hashes.items():
                    starts = bucket_starts(hashes, buckets).tolist()
                    n_main, n_tuning = chunk.own_counts(kind, main), chunk.own_counts(kind, tuning)
                    rows = [
                        (k, kind, row["chunk"], packed_hashes(hashes[a:b]), packed(n_main[a:b]), packed(n_tuning[a:b]))
                        for k, (a, b) in enumerate(zip(starts, starts[1:]))
                        if a < b
                    ]
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), REQUEST_ARROW)]
                    yield pa.RecordBatch.from_arrays(columns, schema=REQUEST_ARROW)

    return ask


def answer(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
    """Adds up a bucket's hashes over its chunks and answers each chunk in the order it asked. The first answer
    also tells how many of a bucket's words occur in training and in the main folds; the start mark is no word."""
    asked = asked.sort_values("chunk")
    hashes = [unpacked_hashes(b) for b in asked["hashes"]]
    every, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    cuts = np.cumsum([len(h) for h in hashes])[:-1]
    out = {"chunk": asked["chunk"], "kind": asked["kind"], "bucket": asked["bucket"]}
    total = {}
    for name in ("main", "tuning"):
        own = np.concatenate([unpacked(b) for b in asked[name]])
        total[name] = np.bincount(inverse, weights=own, minlength=len(every)).astype(np.int64)
        out[name] = [packed(part) for part in np.split(total[name][inverse], cuts)]
    word = every != np.uint64(xxhash.xxh64_intdigest(START))
    rest = [0] * (len(asked) - 1)
    out["types_train"] = [int((word & (total["main"] + total["tuning"] > 0)).sum()), *rest]
    out["types_main"] = [int((word & (total["main"] > 0)).sum()), *rest]
    return pd.DataFrame(out)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64)


def likelihoods(
    both: np.ndarray, context: np.ndarray, word: np.ndarray, n: float, v: float
) -> tuple[np.ndarray, np.ndarray, float]:
    """The bigram, unigram and uniform probability of every token."""
    return both / np.maximum(context, 1), word / max(n, 1), 1 / (v + 1)


def ratio_bins(p: np.ndarray, uniform: float) -> np.ndarray:
    """Bin 0 for probability zero, else the rounded logarithm of p / uniform."""
    with np.errstate(divide="ignore"):
        logs = np.rint(RATIO_STEPS * np.log2(p / uniform))
    return np.where(p > 0, np.clip(logs + RATIO_BINS // 4, 1, RATIO_BINS - 1), 0).astype(np.int64)


def bin_ratio(bins: np.ndarray) -> np.ndarray:
    return np.where(bins > 0, 2.0 ** ((bins - RATIO_BINS // 4) / RATIO_STEPS), 0.0)


def learn(cells: list[tuple[int, int, int, int]], rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per context bucket from (bucket, bigram bin, unigram bin, tokens)."""
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    if not cells:
        return weights
    table = np.array(cells, np.int64)
    bucket, number = table[:, 0], table[:, 3].astype(float)
    ratios = np.stack([bin_ratio(table[:, 1]), bin_ratio(table[:, 2]), np.ones(len(table))], axis=1)
    for _ in range(rounds):
        share = weights[bucket] * ratios
        share *= (number / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], CONTEXT_BUCKETS) for k in range(3)], axis=1)
        # A little of the uniform part is kept, so that no text becomes impossible.
        sums += np.array([0, 0, 1e-3]) + 1e-6 * weights
        weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (crc_of_id(doc_id) % FOLDS).cast("int").alias("fold"),
        F.col(text).alias("text"),
    )
    chunks = cut(rows.mapInArrow(chunked, CHUNK))
    tokens_of = F.expr(
        "aggregate(sequence(0, size(folds) - 1), named_struct('all', 0L, 'train', 0L, 'main', 0L), (a, i) -> "
        "named_struct('all', a.all + ends[i] - if(i = 0, 0, ends[greatest(i - 1, 0)]), "
        f"'train', a.train + if(folds[i] = {HELD_OUT}, 0, ends[i] - if(i = 0, 0, ends[greatest(i - 1, 0)])), "
        f"'main', a.main + if(folds[i] IN ({HELD_OUT}, {TUNING}), 0, ends[i] - if(i = 0, 0, ends[greatest(i - 1, 0)]))))"
    )
    totals = chunks.select(tokens_of.alias("t")).agg(
        *[F.coalesce(F.sum(f"t.{k}"), F.lit(0)).alias(k) for k in ("all", "train", "main")]
    ).first()
    buckets = max(1, -(-totals["all"] // BUCKET_TOKENS))
    asked = chunks.mapInArrow(requests(buckets), REQUEST)
    answers = cut(asked.groupBy("bucket", "kind").applyInPandas(answer, ANSWER))
    types = answers.filter("kind = 1").agg(
        F.coalesce(F.sum("types_train"), F.lit(0)).alias("train"), F.coalesce(F.sum("types_main"), F.lit(0)).alias("main")
    ).first()
    n_train, n_main = int(totals["train"]), int(totals["main"])
    v_train, v_main = int(types["train"]), int(types["main"])

    def tuning_cells(key: tuple, chunk: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own = Chunk(chunk.iloc[0])
        words = own.counts(WORDS, found)[0]
        both = own.counts(PAIRS, found)[0][own.pairs]
        context = words[own.before]
        p2, p1, p0 = likelihoods(both, context, words[own.tokens], n_main, v_main)
        cells = (context_bucket(context) * RATIO_BINS + ratio_bins(p2, p0)) * RATIO_BINS + ratio_bins(p1, p0)
        cell, number = np.unique(cells, return_counts=True)
        return pd.DataFrame(
            {
                "context": cell // RATIO_BINS**2,
                "pair_bin": cell // RATIO_BINS % RATIO_BINS,
                "word_bin": cell % RATIO_BINS,
                "n": number,
            }
        )

    tuning_chunks = chunks.filter("is_tuning")
    tuning_answers = answers.join(tuning_chunks.select("chunk"), "chunk", "left_semi")
    # At most CONTEXT_BUCKETS x RATIO_BINS^2 cells, whatever the corpus.
    cells = (
        tuning_chunks.groupBy("chunk")
        .cogroup(tuning_answers.groupBy("chunk"))
        .applyInPandas(tuning_cells, "context long, pair_bin long, word_bin long, n long")
        .groupBy("context", "pair_bin", "word_bin")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    weights = learn([tuple(c) for c in cells])

    def scores(key: tuple, chunk: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own = Chunk(chunk.iloc[0])
        words = sum(own.counts(WORDS, found))
        both = sum(own.counts(PAIRS, found))[own.pairs]
        context, count = words[own.before], words[own.tokens]
        p2, p1, p0 = likelihoods(both, context, count, n_train, v_train)
        # An unseen context has no bigrams; its bucket gives them no weight.
        weight = weights[context_bucket(context)]
        model = np.log10(weight[:, 0] * p2 + weight[:, 1] * p1 + weight[:, 2] * p0)
        base = np.log10((count + 1) / (n_train + v_train + 1))
        return pd.DataFrame(
            {
                "doc_id": pd.array(list(chunk.iloc[0]["doc_ids"]), dtype="Int64"),
                "held_out": own.folds == HELD_OUT,
                "n_tokens": own.ends - own.starts,
                "n_known": np.add.reduceat((count > 0).astype(np.int64), own.starts),
                "base_score": np.add.reduceat(base, own.starts),
                "score": np.add.reduceat(model, own.starts),
            }
        )

    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(scores, SCORED)
    return scored.withColumn("train_tokens", F.lit(n_train).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

