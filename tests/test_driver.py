"""The driver's contract, with and without the corpus operators."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("loomgraph.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert len(q) > 100 and "pipeline" not in q and not any(k.startswith("op") and k[2].isdigit() for k in q), sorted(q)
assert set(o) <= set(q)
"""


def test_imports_without_the_corpus_operators():
    subprocess.run([sys.executable, "-c", BLOCK], cwd=ROOT, check=True, timeout=120)


def test_every_oracle_belongs_to_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_library_does_not_import_the_corpus_operators():
    for d, _, names in os.walk(os.path.join(ROOT, "loomgraph")):
        if os.path.basename(d) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(d, n)) as f:
                    assert "loomgraph.llm" not in f.read(), n
