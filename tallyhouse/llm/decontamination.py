"""Benchmark decontamination by suffix arrays over the training texts.

Words of the training texts are looked up in the exact vocabulary of the benchmark; words the benchmark lacks get
number 0, which matches nothing. A task strings its texts together into shards of a bounded number of words, with a 0
after each text; a longer text goes on in the next shard, which repeats the words of one window less one. Each shard
builds the array of its suffixes, sorted by as many words as a window has, by prefix doubling; suffixes that meet a 0
before the shortest window is over cannot match one and are left out. All suffixes of the benchmark are then searched
at once: word by word, two binary searches narrow each suffix's interval of the array, whose last non-empty one gives
its longest verbatim match (up to a window) and all places of it. Matches that continue on the same diagonal are
joined into the whole verbatim match.

The texts are read once and never shuffled. The benchmark is cut into pieces, overlapping by a window less one word,
and dealt to blocks of at most about ``BLOCK_WORDS`` words, one pass over the texts for each, so what a task holds does
not grow with the benchmark either; the usual benchmark is one block.

Defined cases: null texts and texts without words have no words, hits or items; an item of fewer words than a window
is one window as a whole, one without words none; repeated documents each get a row; items of the same id count once;
an item without an id marks words like any other and is listed as the empty text; empty tables give no rows, or no
hits. Other columns of either table play no part.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut

WINDOW = 10
SHARD_WORDS = 1 << 20
# Words of the benchmark that one pass over the texts searches for, and of one piece of an item.
BLOCK_WORDS = 1 << 18
PIECE_WORDS = 1 << 16
# A word holds 0-9, a-z and every character beyond ASCII; A-Z are lower-cased first.
WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
TO_WORDS = bytes(b if b in WORD_BYTES else 0x20 for b in bytes(range(256)).lower())


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


class Suffixes:
    """The suffixes of some benchmark pieces, cut to a window, and what each of the different ones stands for.

    ``starts`` lists (piece, first word) of the pieces whose suffix it is; a suffix is a window if it has ``window``
    words, or if it is a whole shorter item.
    """

    def __init__(self, pieces: list[tuple[str, int, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.items = [item for item, _, _ in pieces]
        numbers = self.vocabulary
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        whole: set[tuple[int, ...]] = set()
        for piece, (_, offset, words) in enumerate(pieces):
            ids = [numbers.setdefault(w, len(numbers) + 1) for w in words]
            if len(ids) < window and offset == 0:
                whole.add(tuple(ids))
            for start in range(len(ids)):
                suffix = tuple(ids[start : start + window])
                places = found.setdefault(suffix, [])
                if len(suffix) == window or start == 0:
                    places.append((piece, offset + start))
        self.suffixes = list(found)
        self.starts = list(found.values())
        self.lengths = np.array([len(s) for s in self.suffixes], np.int64)
        self.is_window = np.array([len(s) == window or s in whole for s in self.suffixes], bool)
        self.words = np.zeros((len(self.suffixes), window), np.int64)
        for row, suffix in enumerate(self.suffixes):
            self.words[row, : len(suffix)] = suffix
        self.shortest = int(self.lengths[self.is_window].min(initial=window))
        self.items_of = [frozenset(self.items[p] for p, _ in places) for places in self.starts]

    def numbered(self, text: bytes | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))


def suffix_array(words: np.ndarray, depth: int, shortest: int) -> np.ndarray:
    """The places of the suffixes that have ``shortest`` words before a 0, sorted by their first ``depth`` words, or
    those before the next 0."""
    n = len(words)
    # The words between the zeros on either side of each place; shorter runs hold no match.
    zeros = np.concatenate([[-1], np.flatnonzero(words == 0), [n]])
    after = np.searchsorted(zeros, np.arange(n))
    following, run = zeros[after], zeros[after] - zeros[after - 1] - 1
    places = np.flatnonzero((following - np.arange(n) >= shortest) & (words > 0))
    if not len(places):
        return places
    rank = np.where((run >= shortest) & (words > 0), words, 0).astype(np.int64)
    sorted_by = 1
    while sorted_by < depth:
        shifted = np.zeros(n, np.int64)
        shifted[: n - sorted_by] = rank[sorted_by:]
        known = np.flatnonzero(rank)
        _, dense = np.unique(rank[known] * (int(rank.max()) + 1) + shifted[known], return_inverse=True)
        rank = np.zeros(n, np.int64)
        rank[known] = dense + 1
        sorted_by *= 2
    return places[np.argsort(rank[places], kind="stable")]


def search(words: np.ndarray, array: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix of the benchmark the words of its longest match, and the interval of the array that has it."""
    n = len(tests.suffixes)
    low, high = np.zeros(n, np.int64), np.full(n, len(array))
    matched = np.zeros(n, np.int64)
    padded = np.append(words, np.zeros(tests.window, words.dtype))
    active = np.arange(n) if len(array) else np.zeros(0, np.int64)
    for depth in range(tests.window):
        active = active[tests.lengths[active] > depth]
        if not len(active):
            break
        wanted = tests.words[active, depth]
        bounds = []
        for above in (False, True):
            # The first place in the interval whose word is not below (or is above) the wanted one.
            a, b = low[active], high[active]
            while (open_ := a < b).any():
                middle = (a + b) // 2
                word = padded[array[np.minimum(middle, len(array) - 1)] + depth]
                right = open_ & ((word <= wanted) if above else (word < wanted))
                a = np.where(right, middle + 1, a)
                b = np.where(open_ & ~right, middle, b)
            bounds.append(a)
        hit = bounds[0] < bounds[1]
        active = active[hit]
        low[active], high[active] = bounds[0][hit], bounds[1][hit]
        matched[active] = depth + 1
    return matched, low, high


def occurrences(words: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence of a benchmark window in a shard."""
    array = suffix_array(words, tests.window, tests.shortest)
    matched, low, high = search(words, array, tests)
    whole = np.flatnonzero(tests.is_window & (matched == tests.lengths))
    sizes = (high - low)[whole]
    window = np.repeat(whole, sizes)
    inside = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return array[np.repeat(low[whole], sizes) + inside], window


def in_texts(texts: Iterator[bytes | None], tests: Suffixes, shard_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text, in order: its number of words, and (place, window) of every occurrence of a window in it."""
    overlap = tests.window - 1
    pieces: list[np.ndarray] = []
    # Of the texts that are not finished: the words, the occurrences found so far.
    waiting: list[tuple[int, list]] = []
    # (text among the waiting, its first word in the shard, the shard's place of that word) of each piece.
    origin: list[tuple[int, int, int]] = []
    size = 0

    def close() -> None:
        nonlocal pieces, origin, size
        if pieces:
            places, windows = occurrences(np.concatenate(pieces), tests)
            begins = np.array([at for _, _, at in origin])
            piece = np.searchsorted(begins, places, side="right") - 1
            order = np.argsort(piece, kind="stable")
            bounds = np.searchsorted(piece[order], np.arange(len(origin) + 1))
            for i, (text, first, at) in enumerate(origin):
                mine = order[bounds[i] : bounds[i + 1]]
                if len(mine):
                    waiting[text][1].append((places[mine] - at + first, windows[mine]))
        pieces, origin, size = [], [], 0

    def done() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for n, found in waiting:
            places = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
            windows = np.concatenate([w for _, w in found]) if found else np.zeros(0, np.int64)
            # A short window that lies in the overlap of two shards is found in both.
            if len(found) > 1:
                both = np.unique(np.stack([places, windows]), axis=1)
                places, windows = both
            yield n, places, windows
        waiting.clear()

    for text in texts:
        words = tests.numbered(text)
        waiting.append((len(words), []))
        at = 0
        while len(words) >= tests.shortest:
            piece = words[at : at + max(tests.window, shard_words - size)]
            origin.append((len(waiting) - 1, at, size))
            pieces += [piece, np.zeros(1, np.int32)]
            size += len(piece) + 1
            if size >= shard_words:
                close()
            if at + len(piece) == len(words):
                break
            at += len(piece) - overlap
        if size == 0:
            yield from done()
    close()
    yield from done()


def spans_of(places: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """The places covered, as disjoint spans (first word, word after the last)."""
    order = np.argsort(places, kind="stable")
    starts, ends = places[order], np.maximum.accumulate((places + lengths)[order])
    if not len(starts):
        return []
    first = np.append(True, starts[1:] > ends[:-1])
    last = np.append(first[1:], True)
    return list(zip(starts[first].tolist(), ends[last].tolist()))


class Blocks:
    """The pieces of a benchmark, stored, in blocks of about ``block_words`` words."""

    def __init__(self, benchmark: DataFrame, window: int, block_words: int, item_id: str, text: str):
        def cut_up(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for item, body in zip(batch["item"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                    words = words_of(body)
                    for at in range(0, max(1, len(words) - window + 1) if words else 0, PIECE_WORDS):
                        piece = words[at : at + PIECE_WORDS + window - 1]
                        made = [[item], [at], [len(piece)], [b" ".join(piece)]]
                        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds)], names=["item", "at", "n", "words"])

        named = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
        schema = "item string, at long, n long, words binary"
        self.window = window
        self.pieces = cut(named.mapInArrow(cut_up, schema).dropDuplicates(["item", "at", "words"]))
        self.count = max(1, -(-(self.pieces.agg(F.sum("n")).first()[0] or 0) // block_words))

    def __iter__(self) -> Iterator[Suffixes]:
        """Each block's suffixes; the driver holds one block at a time."""
        block = F.pmod(F.xxhash64("item", "at", "words"), F.lit(self.count))
        for number in range(self.count):
            rows = self.pieces.filter(block == number).collect()
            yield Suffixes([(r["item"], r["at"], bytes(r["words"]).split(b" ")) for r in rows], self.window)


def _pass(docs: DataFrame, text: str, tests: Suffixes, shard_words: int, schema, made: Callable) -> DataFrame:
    """``made`` turns each batch of documents and its texts' results into a batch; batches wait for their shards."""
    shipped = docs.sparkSession.sparkContext.broadcast(pickle.dumps(tests))

    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = pickle.loads(shipped.value)
        waiting: list[pa.RecordBatch] = []

        def texts() -> Iterator[bytes | None]:
            for batch in stream:
                if batch.num_rows:
                    waiting.append(batch)
                    yield from batch[text].cast(pa.binary()).to_pylist()

        results: list[tuple] = []
        for result in in_texts(texts(), tests, shard_words):
            results.append(result)
            if len(results) == waiting[0].num_rows:
                yield made(waiting.pop(0), results, tests)
                results = []

    return docs.mapInArrow(scan, schema)


HITS = "doc_id long, digest string, n_words long, spans array<struct<first:long,after:long>>, items array<string>"
SPANS = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))


def _hits(batch: pa.RecordBatch, results: list[tuple], tests: Suffixes) -> pa.RecordBatch:
    spans, items = [], []
    known: dict[tuple, list[str]] = {}
    for _, places, windows in results:
        spans.append([{"first": a, "after": b} for a, b in spans_of(places, tests.lengths[windows])])
        met = tuple(np.unique(windows).tolist())
        if met not in known:
            known[met] = sorted(frozenset().union(*[tests.items_of[w] for w in met]))
        items.append(known[met])
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], batch["digest"], pa.array([r[0] for r in results], pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))],
        names=["doc_id", "digest", "n_words", "spans", "items"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    benchmark_text: str = "text",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """doc_id, n_words, spans (the words hit, as [first, after)) and items (the ids of those met, sorted) of every document."""
    blocks = Blocks(benchmark, window, block_words, item_id, benchmark_text)
    # Tells documents apart where the results of several blocks meet.
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256) if blocks.count > 1 else F.lit("")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), digest.alias("digest"))
    passes = [_pass(rows, "text", tests, shard_words, HITS, _hits) for tests in blocks]
    if len(passes) == 1:
        return passes[0].drop("digest")
    # Every pass gives each document; equal documents have equal results.
    merged = reduce(DataFrame.unionByName, passes).groupBy("doc_id", "digest").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("_rows"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # Overlapping spans of different blocks are joined.
    joined = """aggregate(_spans, CAST(array() AS array<struct<first:long,after:long>>), (done, s) ->
        CASE WHEN size(done) > 0 AND s.first <= element_at(done, -1).after
             THEN concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first,
                  'after', greatest(element_at(done, -1).after, s.after))))
             ELSE concat(done, array(named_struct('first', s.first, 'after', s.after))) END)"""
    return merged.select(
        "doc_id", "n_words", F.expr(joined).alias("spans"), "items", F.explode(F.sequence(F.lit(1), F.expr(f"CAST(_rows div {len(passes)} AS int)"))).alias("_copy")
    ).drop("_copy")


MATCHES = "doc_id long, item_id string, doc_start long, item_start long, n_words long"


def _matches(batch: pa.RecordBatch, results: list[tuple], tests: Suffixes) -> pa.RecordBatch:
    rows = []
    for doc, (_, places, windows) in zip(batch["doc_id"].to_pylist(), results):
        met = sorted(
            {(tests.items[piece], place - start, place, int(tests.lengths[w])) for place, w in zip(places.tolist(), windows.tolist()) for piece, start in tests.starts[w]}
        )
        for item, diagonal, place, length in met:
            last = rows[-1] if rows else None
            if last and last[0] == doc and last[1] == item and last[2] - last[3] == diagonal and place <= last[2] + last[4]:
                rows[-1] = (*last[:4], place + length - last[2])
            else:
                rows.append((doc, item, place, place - diagonal, length))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in MATCHES.split(", ")])


def verbatim_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    benchmark_text: str = "text", shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every longest verbatim match of a window or more: document, item, first word in either, number of words.

    An item of more than ``PIECE_WORDS`` words may give a match in two rows, where its pieces meet."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = Blocks(benchmark, window, block_words, item_id, benchmark_text)
    return reduce(DataFrame.unionByName, [_pass(rows, "text", tests, shard_words, MATCHES, _matches) for tests in blocks])


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", benchmark_text: str = "text",
    shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    kept = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    column = kept.columns[docs.columns.index(text)]

    def clean(batch: pa.RecordBatch, results: list[tuple], tests: Suffixes) -> pa.RecordBatch:
        return batch.filter(pa.array([not len(places) for _, places, _ in results]))

    for tests in Blocks(benchmark, window, block_words, item_id, benchmark_text):
        kept = _pass(kept, column, tests, shard_words, kept.schema, clean)
    return kept.toDF(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["after"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
