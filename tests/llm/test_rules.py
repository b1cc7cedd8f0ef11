from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import queries, rules, sql
from tests.llm.helpers import MIDDLE, documents, edge_documents, no_documents, read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def counts(row):
    return tuple(row[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))


def test_counts_by_brute_force(spark):
    rows = {r["doc_id"]: r for r in queries.op9_risk_rules(spark, MIDDLE).collect()}
    assert len(rows) == len(documents(MIDDLE))
    for d in documents(MIDDLE):
        row, n = rows[d["doc_id"]], plain(d["text"])
        assert counts(row) == n
        assert row["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (row["base_failed"] and row["kept"])


def test_counts_of_awkward_texts(spark):
    texts = ["a b c a b c a b", "a a a a a", "x\ny\nx\n\n \nx", "a b c", "\x0ba\x0c b\x85c  d", "é|é #1", "A!\nA!\n"]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in rules.measures(frame).collect():
        assert counts(r) == plain(texts[r["doc_id"]])


@pytest.mark.parametrize("n, x, p", [(10, 0, 0.1), (200, 3, 0.02), (5000, 61, 0.01), (100_000, 800, 0.01)])
def test_binomial_probability_is_exact(spark, n, x, p):
    frame = spark.createDataFrame([(n, x)], "n long, x long")
    found = frame.select(rules.log_binomial_cdf("n", "x", p)).first()[0]
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(x + 1)]
    top = max(logs)
    assert found == pytest.approx(top + math.log(sum(math.exp(v - top) for v in logs)), rel=1e-9)


def holdout(spark, n, bad, stratum="en"):
    """n good documents, of which ``bad`` have a symbol share of 0.2."""
    return spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit(stratum).alias("stratum"), F.lit(100).cast("long").alias("n_words"),
        F.lit(500).cast("long").alias("word_chars"), F.when(F.col("id") < bad, 20).otherwise(0).cast("long").alias("n_symbols"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim")],
        F.lit(1).cast("long").alias("n_lines"), F.col("id").alias("text_hash"),
    )


def test_cutoffs_limit_false_rejection(spark):
    measured = holdout(spark, 4000, 400)
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    found = {r["rule"]: r for r in rules.cutoffs(measured, labels).collect()}
    # A tenth of the good documents would fall below 0.2, so the cutoff stays above.
    assert found["symbol_share"]["cutoff"] == 0.25 and found["symbol_share"]["x"] == 0
    assert found["exclaim_share"]["cutoff"] == min(rules.CANDIDATES["exclaim_share"])
    assert all(r["n"] == 4000 for r in found.values())


def test_copies_are_one_trial(spark):
    """Four thousand rows of a hundred texts prove no more than a hundred."""
    measured = holdout(spark, 4000, 0).withColumn("text_hash", F.col("doc_id") % 100)
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    assert rules.cutoffs(measured, labels).count() == 0
    assert {r["n"] for r in rules.cutoffs(measured.withColumn("text_hash", F.col("doc_id") % 2000), labels).collect()} == {2000}


def test_small_holdouts_give_no_cutoff(spark):
    measured = holdout(spark, 100, 0)
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    assert rules.cutoffs(measured, labels).count() == 0


def test_verdicts_agree_with_sql_where_cutoffs_exist(spark):
    """At a risk of 0.6 the languages with the most labels have cutoffs in the small tables too."""
    docs, labels = read(spark, MIDDLE, "documents"), read(spark, MIDDLE, "labels")
    found = rules.verdicts(docs, labels, risk=0.6)
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{MIDDLE}/{name}.parquet')")
    expected = duck.execute(sql.risk_rules_sql(risk=0.6))
    assert [d[0] for d in expected.description] == found.columns
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(expected.fetchall())
    assert any(r[-1] for r in rows) and any(r[-2] for r in rows)


def test_verdicts_follow_the_cutoffs(spark):
    words = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(1200)]
    rows = [(i, t, "en") for i, t in enumerate(words)] + [(9000, " ".join(f"w{j}***" for j in range(60)), "en"), (9001, " ".join(f"w{j}***" for j in range(60)), "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(1200)], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in rules.verdicts(docs, labels).collect()}
    assert not found[9000]["kept"] and "symbol_share" in found[9000]["broken_rules"]
    assert found[9001]["kept"], "a language without labels rejects by the base rule only"
    assert all(found[i]["kept"] for i in range(1200))


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(6, 1), (None, 1), (4, None)], "doc_id long, quality int")
    rows = rules.verdicts(edge_documents(spark), labels).collect()
    assert len(rows) == 9
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] != 6)
    assert rules.verdicts(no_documents(spark), labels).count() == 0
    assert rules.verdicts(edge_documents(spark), labels.limit(0)).count() == 9


def test_plan_is_native(spark, capsys):
    rules.measures(read(spark, MIDDLE, "documents")).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_equal_windows_are_told_by_their_whole_hash(spark):
    """The number of bits kept of a window's hash must not shrink as the text grows."""
    text = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(3_000)), "en")], "doc_id long, text string, lang string")
    plan = rules.measures(text)._jdf.queryExecution().analyzed().toString()
    assert "shiftleft" not in plan and "shiftright" not in plan
    assert rules.measures(text).first()["n_repeat_words"] == 0
