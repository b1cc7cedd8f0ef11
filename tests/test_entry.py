"""The driver's entry point when the training-data folder, or a library it needs, is absent."""

from __future__ import annotations

import subprocess
import sys

import pytest

from tallyhouse.plans.queries import QUERIES

BLOCKED = """
import sys

class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name.startswith({name!r}):
            raise ModuleNotFoundError("No module named " + name, name=name)

sys.meta_path.insert(0, Block())
import __spark_entry__
print(len(__spark_entry__.queries()), len(__spark_entry__.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["ahocorasick", "xxhash", "tallyhouse.llm", "corpus_pipeline"])
def test_the_other_queries_stay(name):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(QUERIES))], out.stderr[-500:]
