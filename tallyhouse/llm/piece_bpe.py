"""SentencePiece encoding and decoding with merge-type (BPE) models, exact and in linear time.

Encoding does not run the merges. An Aho-Corasick automaton lists the pieces that match at every position;
from the left, the longest one is taken whose pairing with the piece before is *compatible*: merging the
joined text of the two again must give back the same two pieces. Where no match fits, the position is marked
as failed in a bitfield, and the piece before is taken back for its next shorter match. A sequence all of
whose neighbours are compatible is the one the merges would have given, since merge priorities are distinct.

Runs of spaces are the exception: the model gives all pieces of spaces only one, lowest, priority. They are
merged last, among the spaces left over, leftmost first, so they are encoded apart from the words. No other
piece holds a space mark after its first place, so words can be encoded one by one and kept in a bounded
cache. Characters without a piece become their UTF-8 bytes, and no merge reaches across them.

Defined cases: null counts as empty; an empty text has no tokens and decodes to the empty text. Texts are
read whole; a word without spaces of any length costs time in proportion to its length. The model must be of
type BPE, with byte pieces, the identity normaliser and a space put before the text; others are refused.
"""

from __future__ import annotations

import heapq
import re
import string
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
# Fixed values of the model file: kinds of pieces, and the fields of its messages that are read.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECE, TRAINER, NORMALISER = 1, 2, 3
# Entries a worker keeps in each generation of words, and of pairs.
CACHED_WORDS = 400_000
CACHED_PAIRS = 2_000_000


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialised message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(message):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = message[i : i + size], i + size
        yield key >> 3, value


class Vocabulary:
    """The pieces of one model, with what encoding and decoding need."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict = {}
        normaliser: dict = {}
        for number, value in fields(model):
            if number == PIECE:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif number == TRAINER:
                trainer = dict(fields(value))
            elif number == NORMALISER:
                normaliser = dict(fields(value))
        if (
            trainer.get(3) != 2
            or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}
            or self.kinds.count(BYTE) != 256
            or normaliser.get(1) != b"identity"
            or normaliser.get(2)
            or not normaliser.get(3, 1)
            or normaliser.get(4, 1)
            or not normaliser.get(5, 1)
            or trainer.get(24)
        ):
            raise ValueError("only BPE models with byte pieces, identity normaliser and a leading space are supported")
        self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode()
        self.score = {p: s for p, s, k in zip(self.pieces, scores, self.kinds) if k == NORMAL}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.known = {p for p in self.ids if len(p) == 1}
        words = [p for p in self.ids if p.strip(SPACE) or p == SPACE]
        if any(SPACE in p[1:] for p in words) or any(c not in self.known for p in words for c in p):
            raise ValueError("a piece joins two words, or holds a character that is no piece")
        if len({self.score[p] for p in words if len(p) > 1}) < sum(len(p) > 1 for p in words):
            raise ValueError("merge priorities are not distinct")
        self.automaton = ahocorasick.Automaton()
        for piece in words:
            if self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), self.ids[piece]))
        self.automaton.make_automaton()
        self.split = self.word_pattern(words).findall
        self.plain = [
            p.replace(SPACE, " ") if k == NORMAL else "" if k == CONTROL else None for p, k in zip(self.pieces, self.kinds)
        ]
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def word_pattern(self, words: list[str]) -> re.Pattern:
        """Cuts a text where no merge can reach across: before a space mark, around line ends without a piece, and
        between a letter or digit and punctuation that no piece holds after a letter or digit."""
        ends = "".join(map(re.escape, (c for c in "\n\t\r" if c not in self.known)))
        after = {b for p in words for a, b in zip(p, p[1:]) if a.isalnum()}
        cut = "".join(map(re.escape, (c for c in string.punctuation if c not in after)))
        # Any other characters and then letters, again as long as the next character may not be cut off.
        part = f"(?:(?![^\\W_])[^{SPACE}{ends}])*[^\\W_]*"
        word = f"{SPACE}?(?=[^{SPACE}{ends}]){part}(?:(?=[^{SPACE}{ends}{cut}]){part})*?(?=[{SPACE}{ends}{cut}]|\\Z)"
        return re.compile(word + f"|{SPACE}" + (f"|[{ends}]" if ends else ""))

    def merged(self, text: str) -> list[str]:
        """The pieces that the merges give, best score first and leftmost on a tie."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.score:
                    heapq.heappush(heap, (-self.score[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces gives the same two pieces."""
        key = a * len(self.pieces) + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            left, right = self.pieces[a], self.pieces[b]
            found = self.pairs[key] = self.merged(left + right) == [left, right]
        return found

    def backtracked(self, text: str) -> list[int]:
        """Ids of a text of known characters without a space mark after its first place."""
        n = len(text)
        matches: list[list[tuple[int, int]]] = [[] for _ in text]
        for end, (length, piece) in self.automaton.iter(text):
            end += 1
            matches[end - length].append((end, piece))
        pairs, size = self.pairs.get, len(self.pieces)
        ids: list[int] = []
        taken: list[tuple[int, int]] = []  # where each piece starts, and which of the matches there it is
        failed = 0
        at = 0
        last = -1
        k = len(matches[0])
        while at < n:
            options = matches[at]
            while k:
                k -= 1
                end, piece = options[k]
                if failed and failed >> end & 1:
                    continue
                if last < 0:
                    break
                fits = pairs(last * size + piece)
                if fits or (fits is None and self.compatible(last, piece)):
                    break
            else:
                failed |= 1 << at
                at, k = taken.pop()
                ids.pop()
                last = ids[-1] if ids else -1
                continue
            taken.append((at, k))
            ids.append(piece)
            at, last = end, piece
            if at < n:
                k = len(matches[at])
        return ids

    def word(self, text: str) -> tuple[bytes, str]:
        """Ids of one word, as 32-bit numbers, and their text. The cache has two generations; what was used since
        the older one was full is kept."""
        made = self.older.pop(text, None)
        if made is None:
            known = self.known
            if known.issuperset(text):
                ids = self.backtracked(text)
            else:
                ids = []
                for is_known, run in groupby(text, known.__contains__):
                    run = "".join(run)
                    ids += self.backtracked(run) if is_known else [self.byte_id[b] for b in run.encode()]
            made = (array("i", ids).tobytes(), self.surface(ids))
        if len(text) < 100:
            if len(self.words) >= CACHED_WORDS:
                self.older = dict(self.words)
                self.words.clear()
            self.words[text] = made
        return made

    def encoded(self, text: str) -> list[int]:
        return array("i", b"".join([word[0] for word in self.encoded_words(text)])).tolist()

    def encoded_words(self, text: str) -> list[tuple[bytes, str]]:
        """What ``word`` gives for each word of a text, with runs of spaces merged."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        get, make = self.words.get, self.word
        words = [get(w) or make(w) for w in self.split(marked)]
        if SPACE + SPACE not in marked:
            return words
        lone = array("i", [self.ids[SPACE]]).tobytes()
        result, run = [], 0
        for entry in words:
            ids = entry[0]
            if ids == lone:
                run += 1
                continue
            if run:
                if ids.startswith(lone):
                    run, ids = run + 1, ids[len(lone) :]
                    entry = (ids, self.surface(array("i", ids)))
                result.append(self.spaces(run))
                run = 0
            result.append(entry)
        if run:
            result.append(self.spaces(run))
        return result

    @lru_cache(maxsize=4096)  # noqa: B019  one vocabulary per worker
    def spaces(self, length: int) -> tuple[bytes, str]:
        ids = [self.ids[p] for p in self.merged(SPACE * length)]
        return array("i", ids).tobytes(), self.surface(ids)

    def surface(self, ids) -> str:
        """The text of pieces, where a piece of bytes that is no UTF-8 gives one replacement character."""
        try:
            return "".join(map(self.plain.__getitem__, ids))
        except TypeError:  # bytes or unknown pieces
            pass
        out: list[str] = []
        raw = bytearray()

        def flush() -> None:
            i = 0
            while i < len(raw):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(raw[i : i + size].decode())
                        i += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    i += 1
            raw.clear()

        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                raw.append(self.byte_of[i])
                continue
            if raw:
                flush()
            if kind == NORMAL:
                out.append(self.pieces[i].replace(SPACE, " "))
            elif kind == UNKNOWN:
                out.append(self.unknown_surface)
        flush()
        return "".join(out)

    def decoded(self, ids) -> str:
        """The text of any sequence of ids; the space put before the text is taken off."""
        ids = list(ids)
        first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), 0)
        text = self.surface(ids)
        starts = ids[first:] and self.pieces[ids[first]].startswith(SPACE)
        return text[1:] if starts else text


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """One vocabulary per worker process and model."""
    return Vocabulary(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_decode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and decoded for every row. The driver reads the model (half a MB) and ships it with the task."""
    model = read_model(model_path)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model)
        for batch in stream:
            values, ends, decoded = [np.zeros(0, np.int32)], [0], []
            for body in batch.column(1).to_pylist():
                words = known.encoded_words(body or "")
                ids = np.frombuffer(b"".join([w[0] for w in words]), np.int32)
                values.append(ids)
                ends.append(ends[-1] + len(ids))
                whole = "".join([w[1] for w in words])
                starts = len(ids) and known.pieces[ids[0]].startswith(SPACE)
                decoded.append(whole[1:] if starts else whole)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
            )

    return rows.mapInArrow(batches, "doc_id long, ids array<int>, decoded string")


def encoded_columns(docs: DataFrame, model_path: str, kept: list[str], text: str = "text") -> DataFrame:
    """The named columns, ids, n_tokens and round_trip: whether decoding the ids gives the text back."""
    model = read_model(model_path)
    rows = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model)
        for batch in stream:
            ids, whole = [], []
            for body in batch.column(len(kept)).to_pylist():
                found = known.encoded(body)
                ids.append(np.array(found, np.int32))
                whole.append(known.decoded(found) == body)
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()), pa.array(whole, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "ids", "n_tokens", "round_trip"])

    return rows.mapInArrow(batches, f"{schema}, ids array<int>, n_tokens long, round_trip boolean")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
