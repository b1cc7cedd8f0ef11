"""Substring dedup: near-duplicate passages through compact windows.

A text is the sequence of its shingles of five words. Under one hash function, the positions of a text form a
Cartesian tree by hash: the node of position c spans [l, r], the longest stretch in which c has the least hash,
and every subsequence of [l, r] that holds c has the same signature. Only spans of at least a passage's length
matter, and those are the runs of equal minima of a sliding window of that length: a run of windows with the
same minimum is one node, and the windows' union its span, cut to a passage's length on either side of the
position. Every stretch of a passage's length lies in the span of its minimum. So a text of n shingles has about 2 n / length
compact windows for each function, found with a few array operations.

Windows of different texts with equal signature collide; signatures that only one text has are dropped. Within a
group of equal signatures every text is compared with two representatives. Windows that no verified passage of their
text covers, and texts of another class than most of the group, are not settled by that: their groups are split by the
minimum of a second function over the same stretch, then of a third and a fourth, an interval join within each text,
and compared with the representatives of the parts; what is left in the end is compared with all of its part. Groups
with no two texts besides their representatives have no pair left and are not split. So a
frequent line in other surroundings is told apart by those, and texts stay uncompared only if they are of one class and
their common windows covered. Pairs are verified on their whole texts: passages of at least 50 words whose shingle sets
have a similarity of 0.8. All groups go the same way, whatever their size.

Texts equal in their words are one text throughout and share a class. Texts linked by a passage, directly or
over others, form a class, named by the smallest doc_id in it. Links within a class are not counted, as most of them are
never looked at.

What can be missed: a passage at similarity s collides under each function with probability s; s = 1 always does.
At s = 0.8 none of the six functions collides with probability 0.0001; for what the first representatives do not
settle a second must, which fails with 0.0016. A window counts as covered if a passage's length of it is. Verification
tries stretches from the first to the last match, widened to a passage's length, and the longest ones at several shares
of matches. It leaves no false links.

Defined cases: null and empty texts and those of under 50 words have no passages; only documents with a
passage are returned, one row for each row of the input (repeated rows are copies of each other); rows
without an id are returned without one, and name a class only if all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache, cached_property, partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import components, cut
from tallyhouse.session import shared_folder

SHINGLE_WORDS = 5
PASSAGE_WORDS = 50
SIMILARITY = 0.8
FUNCTIONS = 6
# Representatives with which the texts of a group are compared first.
REPRESENTATIVES = 2
# Functions whose minima over one stretch split a group, at most.
SPLITS = 4
LENGTH = PASSAGE_WORDS - SHINGLE_WORDS + 1
# Unmatched shingles that a passage may bridge: two words changed next to each other's shingles.
BRIDGE = 2 * SHINGLE_WORDS
# Matched shingles that a passage has at least.
LEAST_MATCHED = -(-int(100 * SIMILARITY) * LENGTH // 100)
# Shares of matched shingles at which the longest stretches are tried.
SHARES = [SIMILARITY, 0.84, 0.87, 2 * SIMILARITY / (1 + SIMILARITY), 0.92, 0.96, 1.0]
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Odd multipliers, one for each hash function.
MULTIPLIERS = [np.uint64(xxhash.xxh64_intdigest(bytes([f])) | 1) for f in range(FUNCTIONS)]
KEY_BITS = 3


class Words:
    """The word hashes of many texts, one after the other: text i has words[starts[i]:starts[i + 1]].

    All texts are hashed together: a word's hash is the difference of two running polynomial sums over the bytes,
    moved to the word's own beginning, and then mixed."""

    def __init__(self, texts: list[bytes | None]):
        body = b"\n".join([t or b"" for t in texts]).translate(LOWER)
        data = np.frombuffer(body, np.uint8)
        inside = np.concatenate([[False], ~WHITE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = edges[::2], edges[1::2]
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        self.words = mixed((sums[ends] - sums[begins]) * down[begins])
        lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        places = np.concatenate([[0], np.cumsum(lengths)])
        self.starts = np.searchsorted(begins, places)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.words[self.starts[i] : self.starts[i + 1]]


WHITE = np.zeros(256, bool)
WHITE[[*range(9, 14), 32]] = True
BASE = 0x9E3779B97F4A7C15
POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse modulo 2^64, kept while they are long enough."""
    if len(POWERS[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            run = np.full(n, np.uint64(base))
            run[0] = 1
            POWERS[k] = np.cumprod(run, dtype=np.uint64)
    return POWERS[0][:n], POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash for each run of five words."""
    n = len(words) - SHINGLE_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        total = total * np.uint64(BASE) + words[k : k + n]
        total ^= total >> np.uint64(31)
    return total


def text_key(words: np.ndarray) -> int:
    """Names a text by its words."""
    return xxhash.xxh64_intdigest(words.tobytes(), len(words)) - (1 << 63)


def sliding_minima(values: np.ndarray, length: int) -> np.ndarray:
    """The least of every ``length`` values in a row."""
    span = 1
    while 2 * span <= length:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return values if span == length else np.minimum(values[: len(values) - length + span], values[length - span :])


def compact_windows(
    hashes: np.ndarray, length: int = LENGTH, valid: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, start, end) of every node that spans at least ``length`` values; the end is exclusive.

    With several texts one after the other, ``valid`` tells which stretches of that length lie in one text."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    minima = sliding_minima(hashes, length)
    at = np.arange(len(minima)) if valid is None else np.flatnonzero(valid)
    if not len(at):
        return np.zeros(0, np.uint64), at, at
    minima = minima[at]
    new = np.concatenate([[0], np.flatnonzero((minima[1:] != minima[:-1]) | (np.diff(at) > 1)) + 1])
    last = np.concatenate([new[1:], [len(at)]]) - 1
    return minima[new], at[new], at[last] + length


def windows_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (key, text_key, start, end) for every hash function; places are relative to their text.

    Of the copies of a text that a task meets only the first counts."""
    seen: set[int] = set()
    for batch in stream:
        bodies = first_copies(batch.column(0).cast(pa.binary()).to_pylist(), seen)
        texts = Words(bodies)
        text_of = np.repeat(np.arange(len(texts)), np.diff(texts.starts))
        reach = PASSAGE_WORDS - 1
        if len(text_of) <= reach:
            continue
        valid = text_of[:-reach] == text_of[reach:]
        names = np.array([text_key(texts[i]) for i in range(len(texts))], np.int64)
        base = shingles(texts.words)
        parts = []
        for f, odd in enumerate(MULTIPLIERS):
            signature, start, end = compact_windows(base * odd, LENGTH, valid)
            own = text_of[start]
            key = (signature >> np.uint64(KEY_BITS) << np.uint64(KEY_BITS)) | np.uint64(f)
            parts.append((key.view(np.int64), names[own], start - texts.starts[own], end - texts.starts[own]))
        key, name, start, end = map(np.concatenate, zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(name), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            names=["key", "text_key", "start", "end"],
        )


def first_copies(bodies: list[bytes | None], seen: set[int]) -> list[bytes | None]:
    """The texts that are not among those seen, by a hash of their bytes; ``seen`` holds one number a text."""
    kept = []
    for body in bodies:
        name = xxhash.xxh64_intdigest(body or b"", 1)
        if name not in seen:
            seen.add(name)
            kept.append(body)
    return kept


def keyed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, text_key, n_words) for the texts that can hold a passage."""
    for batch in stream:
        texts = Words(batch.column(1).cast(pa.binary()).to_pylist())
        sizes = np.diff(texts.starts)
        long = sizes >= PASSAGE_WORDS
        names = [text_key(texts[i]) if ok else 0 for i, ok in enumerate(long.tolist())]
        made = pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())],
            names=["doc_id", "text_key", "n_words"],
        )
        yield made.filter(pa.array(long))


def stretches(matched: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches of true values that bridge short gaps."""
    at = np.flatnonzero(matched)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > BRIDGE + 1)
    return list(zip(at[np.concatenate([[0], breaks + 1])].tolist(), (at[np.concatenate([breaks, [len(at) - 1]])] + 1).tolist()))


class Shingled:
    """A text's shingles: their distinct values in order, the rank of each among these, and the place of the equal
    one before it, -1 if it is the first."""

    def __init__(self, values: np.ndarray):
        self.values = values

    @cached_property
    def kinds(self) -> np.ndarray:
        ranked = np.sort(self.values)
        return ranked[np.concatenate([[True], ranked[1:] != ranked[:-1]])] if len(ranked) else ranked

    @cached_property
    def rank(self) -> np.ndarray:
        return np.searchsorted(self.kinds, self.values)

    @cached_property
    def before(self) -> np.ndarray:
        order = np.argsort(self.values, kind="stable")
        ranked = self.values[order]
        again = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
        before = np.full(len(ranked), -1)
        before[order[again]] = order[again - 1]
        return before


def widened(start: int, end: int, n: int) -> tuple[int, int] | None:
    """The stretch, with unmatched shingles at its ends if it is shorter than a passage."""
    if n < LENGTH:
        return None
    start = max(0, start - max(0, LENGTH - (end - start)))
    return (start, end) if end - start >= LENGTH else (start, start + LENGTH) if start + LENGTH <= n else None


def dense(matched: np.ndarray) -> list[tuple[int, int]]:
    """The longest stretches with several shares of matched shingles, from loose to strict, by running minima of
    the prefix sums of matched less expected; they begin and end with matched shingles."""
    found = []
    before = np.concatenate([[0], np.cumsum(matched)])
    places = np.arange(len(before))
    for share in SHARES:
        surplus = before - share * places + 1e-9
        lowest = np.minimum.accumulate(surplus - 2e-9)
        # The first place whose surplus is no more than the one at the end.
        starts = np.searchsorted(-lowest, -surplus)
        end = int(np.argmax(places - starts))
        if end - starts[end] < LEAST_MATCHED:
            break  # those with larger shares are no longer
        at = np.flatnonzero(matched[starts[end] : end])
        if len(at) >= LEAST_MATCHED:
            pair = (int(starts[end] + at[0]), int(starts[end] + at[-1] + 1))
            if pair not in found:
                found.append(pair)
    return found


def feasible(matched: np.ndarray, before: np.ndarray, start: int, end: int) -> bool:
    """Whether a stretch, with what ``widened`` may add to it, can hold a passage: a part of a passage's length or more
    with the least share of matched shingles.

    Of equal unmatched shingles only the first counts (``before`` is -1), of equal matched ones all: a passage, in which
    each counts once, has no larger share."""
    more = LENGTH - LEAST_MATCHED
    part = slice(max(0, start - more), end + more)
    share = int(100 * SIMILARITY)
    surplus = np.cumsum(np.concatenate([[0], np.where(matched[part], 100 - share, np.where(before[part] < 0, -share, 0))]))
    return len(surplus) > LENGTH and bool((surplus[LENGTH:] >= np.minimum.accumulate(surplus[:-LENGTH])).any())


class Pair:
    """The shingles of two texts, a and b, of which a's are looked up in b's."""

    def __init__(self, a: np.ndarray, b: Shingled):
        self.a, self.b = a, b
        at = np.searchsorted(b.kinds, a)
        at[at == len(b.kinds)] = 0
        self.matched = b.kinds[at] == a if len(b.kinds) else np.zeros(len(a), bool)
        # The last rank is that of all shingles that b has not.
        self.rank = np.where(self.matched, at, len(b.kinds))
        self.flags = np.zeros(len(b.kinds) + 1, bool)

    def among(self, ranks: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which of the ranks are among the others."""
        self.flags[others] = True
        found = self.flags[ranks]
        self.flags[others] = False
        return found

    def parts(self, start: int, end: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Which shingles of b are in a stretch of a, and the stretches of b that hold much of it."""
        matched = self.among(self.b.rank, self.rank[start:end])
        return matched, [(x, y) for x, y in stretches(matched) if np.count_nonzero(matched[x:y]) >= LEAST_MATCHED]

    def passage_at(self, before: np.ndarray, start: int, end: int) -> tuple | None:
        """The best passage that a stretch of a makes with b; ``before`` are the places of equal shingles in a."""
        whole = widened(start, end, len(self.a))
        if whole is None:
            return None
        fresh = before[whole[0] : whole[1]] < whole[0]
        n = int(np.count_nonzero(fresh))
        if np.count_nonzero(self.matched[whole[0] : whole[1]] & fresh) / n < SIMILARITY:
            return None
        matched, others = self.parts(*whole)
        earlier = self.b.before

        def similarity(x: int, y: int) -> float:
            distinct = earlier[x:y] < x
            both = int(np.count_nonzero(matched[x:y] & distinct))
            return both / (n + int(np.count_nonzero(distinct)) - both)

        likely = [(x, y) for x, y in others if feasible(matched, earlier, x, y)]
        for inner in (False, True):
            places = likely if not inner else [(x + u, x + v) for x, y in likely for u, v in dense(matched[x:y])]
            wide = [w for w in (widened(x, y, len(matched)) for x, y in places) if w]
            scored = [(similarity(x, y), x, y) for x, y in wide]
            if scored and max(scored)[0] >= SIMILARITY:
                score, x, y = max(scored)
                return (*whole, x, y, score)
        return None

    def cuts(self, start: int, end: int) -> list[int]:
        """Where the stretches of a[start:end] begin and end, from its start, that the parts of b hold."""
        whole = widened(start, end, len(self.a))
        others = self.parts(*whole)[1] if whole else []
        held = [self.among(self.rank[start:end], self.b.rank[x:y]) for x, y in others]
        return [c for part in held for pair in stretches(part) for c in pair]


def shared_passages(a: np.ndarray, b: np.ndarray, known: Shingled | None = None) -> list[tuple[int, int, int, int, float]]:
    """(start, end, start, end, similarity) of the passages that two texts share, in shingles, ends exclusive.

    ``known`` are the shingles of b, if they are in order already."""
    passages = []
    pair = Pair(a, known or Shingled(b))
    matched = pair.matched
    # Most pairs have a line in common and no more.
    if np.count_nonzero(matched) < LEAST_MATCHED:
        return []
    count = np.concatenate([[0], np.cumsum(matched)])
    todo = [(x, y) for x, y in stretches(matched) if count[y] - count[x] >= LEAST_MATCHED]
    before = Shingled(a).before if todo else np.zeros(0, np.int64)
    # A part of a stretch often has the same dense places as the whole.
    tried = cache(partial(pair.passage_at, before))
    while todo:
        start, end = todo.pop()
        if count[end] - count[start] < LEAST_MATCHED or not feasible(matched, before, start, end):
            continue
        passage = tried(start, end) or next(
            (found for x, y in dense(matched[start:end]) if (found := tried(start + x, start + y))), None
        )
        if passage:
            passages.append(passage)
            todo += [(x, y) for x, y in ((start, passage[0]), (passage[1], end)) if x < y]
            continue
        # The stretch is too long for any part of the other text: cut it where the other text's parts end,
        # or else where it matches least.
        inside = {c for c in pair.cuts(start, end) if 0 < c < end - start}
        if inside:
            bounds = [0, *sorted(inside), end - start]
            todo += [(start + x, start + y) for x, y in zip(bounds, bounds[1:])]
        else:
            missed = start + np.flatnonzero(~matched[start:end])
            if len(missed):
                around = count[np.minimum(missed + LENGTH // 2, end)] - count[np.maximum(missed - LENGTH // 2, start)]
                least = int(missed[np.argmin(around)])
                todo += [(start, least), (least + 1, end)]
    return sorted(set(passages))


def shingled_texts(bodies: list[bytes]) -> list[np.ndarray]:
    """The shingles of compressed texts, all made together."""
    texts = Words([zstandard.decompress(body) for body in bodies])
    values = shingles(texts.words)
    begins, ends = texts.starts[:-1].tolist(), texts.starts[1:].tolist()
    return [values[x : max(x, y - SHINGLE_WORDS + 1)] for x, y in zip(begins, ends)]


def verify(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, a_body, b_body), in runs of equal a, to the verified passages of both texts, in words."""
    last, known = None, None
    more = SHINGLE_WORDS - 1
    for batch in stream:
        others = shingled_texts(batch.column(3).to_pylist())
        names = batch.column(0).to_pylist()
        fresh = [i for i, name in enumerate(names) if name != (names[i - 1] if i else last)]
        firsts = dict(zip(fresh, shingled_texts(batch.column(2).take(pa.array(fresh, pa.int64())).to_pylist())))
        rows = []
        for i, (a, b, other) in enumerate(zip(names, batch.column(1).to_pylist(), others)):
            if i in firsts:
                last, known = a, Shingled(firsts[i])
            for start, end, x, y, score in shared_passages(other, known.values, known):
                rows.append((a, b, x, y + more, start, end + more, score))
        if rows:
            names = ["a", "b", "a_start", "a_end", "b_start", "b_end", "similarity"]
            kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def representatives() -> list[Column]:
    """The first texts of a group, by hashes that are the same in all groups, so that a family has the same
    representatives under all its signatures."""
    return [F.min_by("text_key", F.xxhash64("text_key", F.lit(seed))) for seed in range(REPRESENTATIVES)]


def colliding_windows(docs: DataFrame, text: str) -> DataFrame:
    """(group, functions, text_key, start, end, representatives, large) of the windows whose signature two texts have;
    one of each set of copies.

    The windows are made and shuffled once; those of one text alone go where they arrive. A group is large if it has
    two texts besides its representatives: all pairs of others have a representative and are compared at once."""
    windows = docs.select(F.col(text).alias("text")).mapInArrow(windows_of, "key long, text_key long, start int, end int")
    same_key = Window.partitionBy("key")
    return cut(
        windows.repartition("key")
        .dropDuplicates(["key", "text_key", "start", "end"])
        .withColumns({"_low": F.min("text_key").over(same_key), "_high": F.max("text_key").over(same_key)})
        .filter("_low < _high")
        .withColumns({f"_r{i}": r.over(same_key) for i, r in enumerate(representatives())})
        .withColumn("representatives", F.array_distinct(F.array([f"_r{i}" for i in range(REPRESENTATIVES)])))
        .withColumn("_other", F.when(~F.array_contains("representatives", F.col("text_key")), F.col("text_key")))
        .withColumn("large", F.coalesce(F.min("_other").over(same_key) < F.max("_other").over(same_key), F.lit(False)))
        .select(
            F.col("key").alias("group"),
            F.expr(f"CAST(shiftleft(1, CAST(`key` & {(1 << KEY_BITS) - 1} AS int)) AS int)").alias("functions"),
            "text_key",
            "start",
            "end",
            "representatives",
            "large",
        )
    )


def ordered(pairs: DataFrame) -> DataFrame:
    """(a, b), a < b, of (text_key, r_text_key), once each."""
    return (
        pairs.filter("text_key <> r_text_key")
        .select(F.least("text_key", "r_text_key").alias("a"), F.greatest("text_key", "r_text_key").alias("b"))
        .distinct()
    )


def with_representatives(groups: DataFrame) -> DataFrame:
    """(a, b): every text of a group with the group's representatives."""
    return ordered(groups.select("text_key", F.explode("representatives").alias("r_text_key")))


# Places of a text that meet in a join of its stretches.
BIN = 128


def binned(frame: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each bin of the text that the stretch touches."""
    return frame.withColumn("_bin", F.explode(F.expr(f"sequence({start} div {BIN}, ({end} - 1) div {BIN})")))


def joint_groups(groups: DataFrame, windows: DataFrame) -> DataFrame:
    """The groups split by the minimum of one more function over the same stretch. Signatures joined
    by exclusive or name a set of them whatever their order."""
    more = windows.select(
        "text_key", F.col("group").alias("_group"), F.col("functions").alias("_function"), F.col("start").alias("_start"), F.col("end").alias("_end")
    )
    start, end = F.greatest("start", "_start"), F.least("end", "_end")
    split = (
        binned(groups, "start", "end")
        .join(binned(more, "_start", "_end"), ["text_key", "_bin"])
        .filter((F.col("functions").bitwiseAND(F.col("_function")) == 0) & (end - start >= LENGTH))
        .select(
            F.col("group").bitwiseXOR(F.col("_group")).alias("group"),
            F.col("functions").bitwiseOR(F.col("_function")).alias("functions"),
            "text_key",
            start.alias("start"),
            end.alias("end"),
        )
        .distinct()
    )
    shared = (
        split.groupBy("group")
        .agg(
            F.min("text_key").alias("_low"),
            F.max("text_key").alias("_high"),
            F.array_distinct(F.array(*representatives())).alias("representatives"),
        )
        .filter("_low < _high")
    )
    return split.join(shared.select("group", "representatives"), "group")


def large_groups(groups: DataFrame) -> DataFrame:
    """The windows of groups that have two texts besides their representatives; all pairs of the others were compared."""
    others = groups.filter(~F.array_contains("representatives", F.col("text_key"))).groupBy("group")
    more = others.agg(F.min("text_key").alias("_low"), F.max("text_key").alias("_high")).filter("_low < _high")
    return groups.join(more, "group", "left_semi").drop("representatives")


def unsettled(groups: DataFrame, found: DataFrame) -> DataFrame:
    """The windows of large groups that still need partners, with ``covered`` and the class of their text: those
    that no verified passage of their text covers, and those of other classes than most of their group. Texts of one
    class whose windows are covered need no comparison with each other."""
    spans = merged_spans(found).select("text_key", F.col("start").alias("_start"), (F.col("end") - (SHINGLE_WORDS - 1)).alias("_end"))
    covered = (
        binned(groups, "start", "end")
        .join(binned(spans, "_start", "_end"), ["text_key", "_bin"])
        .filter(F.least("end", "_end") - F.greatest("start", "_start") >= LENGTH)
        .select("group", "text_key", "start", "end")
        .distinct()
        .withColumn("covered", F.lit(True))
    )
    classes = components(groups.select(F.col("text_key").alias("node")), found.select("a", "b")).toDF("text_key", "class")
    marked = cut(
        groups.join(covered, ["group", "text_key", "start", "end"], "left")
        .join(classes, "text_key")
        .withColumn("covered", F.coalesce("covered", F.lit(False)))
    )
    most = (
        marked.groupBy("group", "class")
        .count()
        .groupBy("group")
        .agg(F.max_by("class", F.struct("count", "class")).alias("most"))
    )
    return cut(marked.join(most, "group").withColumn("active", ~F.col("covered") | (F.col("class") != F.col("most"))))


def active_pairs(marked: DataFrame) -> DataFrame:
    """The pairs of a group that need a comparison: of different classes, or with a window that is not covered."""
    theirs = marked.select("group", F.col("text_key").alias("r_text_key"), F.col("class").alias("r_class"))
    return ordered(
        marked.filter("active").join(theirs, "group").filter("NOT covered OR class <> r_class").select("text_key", "r_text_key")
    )


def packed_texts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (text_key, body): compressed, as texts are the bulk of what is shuffled; a task's copies once."""
    seen: set[int] = set()
    for batch in stream:
        bodies = first_copies(batch.column(0).cast(pa.binary()).to_pylist(), seen)
        texts = Words(bodies)
        long = [i for i, n in enumerate(np.diff(texts.starts).tolist()) if n >= PASSAGE_WORDS]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([text_key(texts[i]) for i in long], pa.int64()),
                pa.array([zstandard.compress(bodies[i], 3) for i in long], pa.binary()),
            ],
            names=["text_key", "body"],
        )


def store_texts(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(text_key, body) of the wanted texts, written to the shared folder. They are found by what they say."""
    bodies = docs.select(F.col(text).alias("text")).mapInArrow(packed_texts, "text_key long, body binary")
    folder = shared_folder(docs.sparkSession, "passage-texts")
    one = bodies.join(wanted, "text_key", "left_semi").groupBy("text_key").agg(F.min("body").alias("body"))
    one.write.option("compression", "none").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


# Portions in which pairs are verified one after the other, at most, and the pairs of one from which on there are
# several: the texts, copied for each pair, are the bulk of what is on disk, and go with their portion.
PORTIONS = 8
PORTION_PAIRS = 20_000


def verified_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The shared passages of pairs of texts. The join by a leaves the rows of one text together; a text that many
    others share a passage with is split."""
    found = []
    portions = min(PORTIONS, 1 + pairs.count() // PORTION_PAIRS)
    for portion in range(portions):
        of_portion = F.pmod(F.xxhash64("b"), F.lit(portions)) == portion
        bodies = texts.select(F.col("text_key").alias("b"), F.col("body").alias("b_body")).filter(of_portion)
        with_b = pairs.filter(of_portion).join(bodies, "b")
        both = with_b.join(texts.select(F.col("text_key").alias("a"), F.col("body").alias("a_body")), "a")
        found.append(
            cut(
                both.select("a", "b", "a_body", "b_body").mapInArrow(
                    verify, "a long, b long, a_start int, a_end int, b_start int, b_end int, similarity double"
                )
            )
        )
    return reduce(DataFrame.union, found)


def both_sides(found: DataFrame) -> DataFrame:
    """(text_key, other, start, end) of verified passages, from either text's side."""
    return found.select(
        F.col("a").alias("text_key"), F.col("b").alias("other"), F.col("a_start").alias("start"), F.col("a_end").alias("end")
    ).union(found.select("b", "a", "b_start", "b_end"))


def merged_spans(found: DataFrame) -> DataFrame:
    """(text_key, start, end) of the words that passages cover, as disjoint spans of at least a passage each.

    The furthest end for each start is kept before the spans of a text are put in order, so a text that very many
    share passages with has no more rows than words."""
    ends = both_sides(found).groupBy("text_key", "start").agg(F.max("end").alias("end"))
    order = Window.partitionBy("text_key").orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(reach >= F.col("start"), 0).otherwise(1)
    islands = ends.withColumn("_first", first).withColumn("_island", F.sum("_first").over(order))
    return islands.groupBy("text_key", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def verified(docs: DataFrame, text: str = "text") -> DataFrame:
    """The shared passages. All groups are treated alike: their texts are compared with representatives; the windows
    that are not settled thereby are split by further functions, and what is left of a group in the end is compared
    with the whole of it."""
    windows = colliding_windows(docs, text)
    tried = cut(with_representatives(windows))
    texts = store_texts(docs, windows.select("text_key").distinct(), text)
    found = verified_pairs(tried, texts)

    def compared(pairs: DataFrame) -> None:
        nonlocal tried, found
        new = cut(pairs.join(tried, ["a", "b"], "left_anti"))
        if not new.isEmpty():
            tried, found = tried.union(new), found.union(verified_pairs(new, texts))

    columns = ["group", "functions", "text_key", "start", "end"]
    windows = windows.filter("large").select(columns)
    groups = windows
    for _ in range(2, SPLITS + 1):
        marked = unsettled(groups, found)
        # A group without an unsettled window is done.
        rest = marked.join(marked.filter("active").select("group").distinct(), "group")
        groups = cut(joint_groups(rest.select(columns), windows))
        if groups.isEmpty():
            return found
        compared(with_representatives(groups))
        groups = large_groups(groups)
    compared(active_pairs(unsettled(groups, found)))
    return found


# Shuffle files go with the job that wrote them, not with the driver's next collection of garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id, n_copies and passages (start:end in words) of every document that shares one.

    Every step is stored, so that its shuffle files can be dropped."""
    with shuffles_dropped(docs.sparkSession):
        return _repeated_passages(docs, doc_id, text)


def _repeated_passages(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = cut(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
            keyed, "doc_id long, text_key long, n_words long"
        )
    )
    found = verified(docs, text)
    spans = merged_spans(found).groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    texts = rows.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("_first"), F.max("n_words").alias("n_words")
    )
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    # All of a text that has copies is a passage.
    kept = cut(
        texts.join(spans, "text_key", "left")
        .filter("_spans IS NOT NULL OR n_copies > 1")
        .withColumn("_spans", F.when(F.col("n_copies") > 1, whole).otherwise(F.col("_spans")))
    )
    classes = components(kept.select(F.col("text_key").alias("node")), found.select("a", "b"))
    named = kept.join(classes.withColumnRenamed("node", "text_key"), "text_key")
    smallest = named.groupBy("component").agg(F.min("_first").alias("class_id"))
    labelled = named.join(smallest, "component").select(
        "text_key",
        "class_id",
        "n_copies",
        F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("passages"),
    )
    return rows.select("doc_id", "text_key").join(labelled, "text_key").drop("text_key")
