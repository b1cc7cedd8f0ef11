"""Frames with the awkward cases, and readers of the small tables."""

from __future__ import annotations

import pyarrow.parquet as pq

from tallyhouse.llm.common import prepare

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, shard string, slot int, "
    "position int, fp string, place string, x int, kept int, block int, component string, start int, "
    "_place int, _position int, _POSITION_ int, _source string, _row int, _part int"
)
EXTRA = ("s", "s", 1, 2, "f", "p", 3, 4, 5, "c", 6, 7, 8, 9, "t", 10, 11)
LONG = " ".join(f"word{i % 977} and" for i in range(30_000))


def edge_documents(spark):
    """Nulls in every column, empty and white texts, a very long one, repeated rows, clashing extra columns."""
    prepare(spark)
    rows = [
        (1, None, "en", "a", None, *EXTRA),
        (2, "", "en", "a", 0, *EXTRA),
        (3, " \t\n ", None, None, 4, *EXTRA),
        (4, "one two three", "en", "b", 13, *EXTRA),
        (4, "one two three", "en", "b", 13, *EXTRA),
        (5, "one two three", "de", None, 13, *EXTRA),
        (None, "Ünï çødé 🙂 text", None, "b", None, *[None] * 17),
        (None, None, None, None, None, *[None] * 17),
        (6, LONG, "en", "a", len(LONG), *EXTRA),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def documents(folder: str) -> list[dict]:
    return pq.read_table(f"{folder}/documents.parquet").to_pylist()


def read(spark, folder: str, name: str):
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")
