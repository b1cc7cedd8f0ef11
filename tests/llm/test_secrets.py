from __future__ import annotations

import hashlib
import random
import re

from tallyhouse.llm import queries, secrets
from tests.llm.helpers import MIDDLE, documents, edge_documents, no_documents

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    """The base findings as they are defined."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_findings_by_brute_force(spark):
    rows = {r["doc_id"]: r for r in queries.op3_linked_secrets(spark, MIDDLE).collect()}
    found = 0
    for d in documents(MIDDLE):
        spans, row = plain(d["text"] or ""), rows[d["doc_id"]]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in secrets.BASE] == [sum(s[0] == k for s in spans) for k in secrets.BASE]
        found += len(spans)
    assert len(rows) == len(documents(MIDDLE)) and found > 10


def test_base_findings_on_random_text():
    rng = random.Random(3)
    words = ["token", "TOKEN=", "api_key", "apikey: ", "secret", "ſecret=abcdefgh", "toKen=abcdefgh", "abcdef", "=", ":", " ", '"', "x" * 6, "AKIA", "A1" * 9, "0f" * 12, "é"]
    for _ in range(3000):
        text = "".join(rng.choice(words) for _ in range(rng.randint(1, 9)))
        base = [s for s in secrets.findings(text) if s[0] in secrets.BASE]
        assert base == plain(text)


def test_interval_join_by_brute_force():
    rng = random.Random(4)
    for _ in range(500):
        spans = [("x", a, a + rng.randint(1, 9)) for a in (rng.randint(0, 400) for _ in range(rng.randint(0, 12)))]
        start = rng.randint(0, 400)
        end = start + rng.randint(1, 60)
        assert secrets.Reach(spans).meets(start, end) == any(a <= end and b >= start for _, a, b in spans)


def test_weak_parts_need_a_partner():
    opaque = "Zx9Qw8Er7Ty6Ui5Op4As3Df2"
    assert secrets.findings(opaque) == []
    assert secrets.findings("see https://host.example/path for more") == []
    assert secrets.findings("login: alice, hello") == []
    kinds = [s[0] for s in secrets.findings(f"user: alice {opaque} https://host.example/a")]
    assert kinds == ["user", "opaque", "endpoint"]
    assert secrets.findings(f"user: alice {'. ' * 200}{opaque}") == []
    assert [s[0] for s in secrets.findings("https://host.example/a password=abcdef1")] == ["endpoint", "assign"]


def test_awkward_rows(spark):
    rows = secrets.digests(secrets.scan(edge_documents(spark))).collect()
    assert len(rows) == 9
    assert {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert secrets.scan(no_documents(spark)).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "a password=abcdef1 b", 20), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long"
    )
    rows = {r["doc_id"]: r for r in secrets.redacted(docs).collect()}
    assert (rows[1]["text"], rows[1]["n_chars"]) == ("a [secret] b", 12)
    assert rows[2]["text"] == "clean" and rows[3]["text"] is None
    assert secrets.redacted(edge_documents(spark)).count() == 9
