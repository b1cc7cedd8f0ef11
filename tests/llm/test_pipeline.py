from __future__ import annotations

from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tallyhouse.llm import mixing, queries, secrets
from tests.llm.helpers import MIDDLE, edge_documents, no_documents, read
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_by_brute_force(spark, tmp_path):
    """Each stage on what its predecessor kept, against a plain computation of the same rule."""
    docs = read(spark, MIDDLE, "documents")
    made = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, MIDDLE).write.parquet(path)
        docs = spark.read.parquet(path)
        made.append((docs.columns, [r.asDict() for r in docs.collect()]))
    columns = read(spark, MIDDLE, "documents").columns
    assert [c for c, _ in made[:-1]] == [columns] * 4
    accepted, unique, redacted, ordered, encoded = [rows for _, rows in made]

    predicted = {r["doc_id"]: r["predicted"] for r in queries.op10_quadratic(spark, MIDDLE).collect()}
    assert sorted(r["doc_id"] for r in accepted) == sorted(i for i, p in predicted.items() if p)

    rows = sorted(accepted, key=lambda r: r["doc_id"])
    names = plain_components([plain_fingerprint(r["text"]) for r in rows])
    assert sorted(r["doc_id"] for r in unique) == [rows[i]["doc_id"] for i in sorted(set(names))]

    before = {r["doc_id"]: r for r in unique}
    assert {r["doc_id"] for r in redacted} == set(before)
    for r in redacted:
        text = before[r["doc_id"]]["text"]
        assert r["text"] == secrets.without(text, secrets.findings(text))
        assert r["n_chars"] == (len(r["text"]) if r["text"] != text else before[r["doc_id"]]["n_chars"])

    assert sorted(map(repr, ordered)) == sorted(map(repr, redacted))
    sizes = Counter(r["source"] for r in ordered)
    assert len(sizes) > 2

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in ordered}
    assert len(encoded) == len(texts)
    for r in encoded:
        assert r["ids"] == library.encode(texts[r["doc_id"]]) and r["round_trip"] and r["n_tokens"] == len(r["ids"])


def test_mixed_order_survives_writing(spark, tmp_path):
    docs = read(spark, MIDDLE, "documents")
    expected = [r["doc_id"] for r in mixing.mix(docs).orderBy("position").collect()]
    path = str(tmp_path / "mixed")
    corpus_pipeline.source_mix(spark, docs, MIDDLE).write.parquet(path)
    assert [r["doc_id"] for r in spark.read.parquet(path).collect()] == expected


def test_run_is_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, MIDDLE)
    assert rows.columns == ["doc_id", "source", "ids", "n_tokens", "round_trip"]
    assert rows.count() == rows.select("doc_id").distinct().count() > 500
    assert "pipeline" in queries.registry()


def test_awkward_rows(spark, tmp_path):
    for number, frame in enumerate((edge_documents(spark), no_documents(spark))):
        path = str(tmp_path / f"start-{number}")
        frame.write.parquet(path)
        docs = spark.read.parquet(path)
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{number}-{name}")
            stage(spark, docs, MIDDLE).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.columns[:2] == ["doc_id", "source"]
