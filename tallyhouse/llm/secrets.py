"""Secret scans with multipart credential linking.

Strong findings stand alone: assignments to a secret's name, cloud access keys and long hexadecimal runs.
Weak ones - a user name, an endpoint, an opaque random-looking string - say little by themselves. They are
reported only when a complementary part lies in their scope, the ``REACH`` code points around them: an opaque
string next to an access identifier, a user name next to a secret, an endpoint next to a secret. The parts of
a document are joined as intervals: parts of one role are sorted by start with the running maximum of their
ends, and a weak part finds by binary search whether any of them reaches its scope. That takes n log n steps
however many parts a document has, and as no scope leaves its document, nothing is shuffled.

Defined cases: a null text counts as empty and has no findings; texts are read whole; repeated rows get equal
findings. Spans are in code points, end exclusive, and of whole matches. Findings of one kind never overlap.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which equal starts are listed, the base ones first.
KINDS = ("assign", "access", "hex", "user", "endpoint", "opaque")
BASE = KINDS[:3]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
USER = re.compile(
    r"""(user_?(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""",
    re.ASCII | re.IGNORECASE,
)
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]+""")
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")

REACH = 200
LEAST_ENTROPY = 3.5
PLACEHOLDER = "[secret]"

Span = tuple[str, int, int]


def random_looking(text: str) -> bool:
    """Upper case, lower case and digits, spread widely enough."""
    if not (any(map(str.isdigit, text)) and any(map(str.isupper, text)) and any(map(str.islower, text))):
        return False
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) >= LEAST_ENTROPY


def strong(text: str) -> list[Span]:
    """The base findings of a text."""
    spans: list[Span] = []
    lower = text.lower()
    if "passw" in lower or "secret" in lower or "token" in lower or "api" in lower:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more is what the base pattern's maximal runs keep.
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def weak(text: str, taken: list[Span]) -> list[Span]:
    """Candidates that need a complementary part. An opaque string inside another finding is none."""
    spans: list[Span] = []
    if "=" in text or ":" in text:
        spans += [("user", *m.span()) for m in USER.finditer(text)]
        if "://" in text:
            spans += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    covered = Reach([*taken, *spans])
    spans += [
        ("opaque", *m.span())
        for m in OPAQUE.finditer(text)
        if random_looking(m[0]) and not covered.meets(m.start() + 1, m.end() - 1)
    ]
    return spans


class Reach:
    """Intervals sorted by start, with the largest end so far: whether any meets a given interval."""

    def __init__(self, spans: list[Span]):
        ordered = sorted((start, end) for _, start, end in spans)
        self.starts = [start for start, _ in ordered]
        self.ends = list(accumulate((end for _, end in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_right(self.starts, end)
        return before > 0 and self.ends[before - 1] >= start


def linked(candidates: list[Span], base: list[Span], reach: int = REACH) -> list[Span]:
    """The weak candidates whose scope holds a complementary part."""

    def of(spans: list[Span], *kinds: str) -> Reach:
        return Reach([s for s in spans if s[0] in kinds])

    def in_scope(spans: list[Span], kind: str, parts: Reach) -> list[Span]:
        return [s for s in spans if s[0] == kind and parts.meets(s[1] - reach, s[2] + reach)]

    opaque = in_scope(candidates, "opaque", of(base + candidates, "access", "user"))
    secrets = of(base + opaque, "assign", "hex", "opaque")
    return opaque + in_scope(candidates, "user", secrets) + in_scope(candidates, "endpoint", secrets)


def findings(text: str | None, reach: int = REACH) -> list[Span]:
    """All findings of a text by start, then kind as listed."""
    text = text or ""
    base = strong(text)
    candidates = weak(text, base)
    # A lone weak candidate cannot be complemented.
    spans = base + (linked(candidates, base, reach) if candidates and len(candidates) + len(base) > 1 else [])
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """doc_id and spans (kind, start, end) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in findings(body, reach)]
                for body in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return rows.mapInArrow(batches, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and joined spans of a scan."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def without(text: str, spans: list[Span]) -> str:
    """The text with a placeholder for every stretch the spans cover."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], PLACEHOLDER]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The documents with all their columns; findings are replaced, and n_chars is set where a text changed."""
    names = docs.columns
    place, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    schema = docs.schema

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = batch.column(place).to_pylist()
            sizes = batch.column(size).to_pylist() if size is not None else []
            changed = False
            for i, body in enumerate(texts):
                if spans := findings(body, reach):
                    texts[i], changed = without(body, spans), True
                    if size is not None:
                        sizes[i] = len(texts[i])
            if changed:
                batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
                if size is not None:
                    batch = batch.set_column(size, batch.schema.field(size), pa.array(sizes, batch.schema.field(size).type))
            yield batch

    return docs.mapInArrow(batches, schema)
